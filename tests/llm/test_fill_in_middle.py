"""Fill-in-the-middle against a plain form of its rules."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorchmap.llm import fill_in_middle as fim


def plainly(doc_id, text, options):
    """n, form, prefix_chars, middle_chars, output."""
    text = text or ""
    unit = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"{options.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(unit)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= options.percent:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(unit[x:y]) for x, y in ((0, low), (low, high), (high, n)))
    if h[3] % 100 < options.spm_percent:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts():
    rnd = random.Random(5)
    odd = ["", None, "a", "é", "<P>", "x <S", "< P>", "ab<M>c", "<P", ">", "\n\t \r\n", "ab1cd", "日本語 text ﬁ", "a\u0000b", "<" * 40, "S>" * 30]
    mixed = ["".join(rnd.choices("abZ <>PSM1é日\n", k=rnd.randint(1, 80))) for _ in range(300)]
    return odd + mixed


@pytest.mark.parametrize("options", [fim.Options(), fim.Options(seed=7, percent=100, spm_percent=50)])
def test_forms(spark, options):
    rows = [*enumerate(texts()), (None, "no id here"), (3, "é"), (3, "other text of the same id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit("x"), "output": F.lit(1), "form": F.lit(2)}).repartition(3)
    got = fim.fill_in_middle(docs, options).withColumn("restored", fim.restore())
    key = lambda r: tuple(map(repr, r))
    want = [(k, *plainly(k, t, options), t or "") for k, t in rows]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert {r[2] for r in want} == ({"plain", "psm", "spm"})
    assert fim.fill_in_middle(docs.limit(0)).count() == 0


def test_a_very_long_text(spark):
    """Its boundaries fill arrays, bitmaps and runs of many containers."""
    rnd = random.Random(3)
    text = "".join(rnd.choices("ab cdé.", k=300_000)) + "1" * 200_000 + "word of letters " * 20_000 + "z" * 150_000
    rows = [(k, text) for k in range(4)]
    got = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("restored", fim.restore())
    assert sorted(map(tuple, got.collect())) == sorted((k, *plainly(k, t, fim.Options()), t) for k, t in rows)
    ends = fim.unit_ends(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    kinds = {type(c).__name__ for c in fim.BoundarySet(ends).containers}
    assert kinds == {"_Array", "_Bitmap", "_Runs"}


@pytest.mark.parametrize("share", [0.01, 0.3, 0.9, 1.0])
def test_select_by_rank(share):
    rnd = np.random.default_rng(1)
    positions = np.flatnonzero(rnd.random(400_000) < share)
    positions = positions[(positions < 70_000) | (positions > 210_000)]  # some containers are not there
    found = fim.BoundarySet(positions)
    rank = rnd.permutation(len(positions))
    assert (found.select(rank) == positions[rank]).all() and found.size == len(positions)
    assert len(fim.BoundarySet(positions[:0]).select(rank[:0])) == 0
