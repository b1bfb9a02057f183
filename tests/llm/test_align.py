"""Alignment of two tokenizations against the libraries and plain loops."""

import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scorchmap.llm import align

A, B = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def byte_letters():
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.letters = byte_letters()

    def tokens(self, text):
        """(id, bytes) of both, or nothing."""
        if not text:
            return [], []
        e = self.a.encode(" " + text, add_special_tokens=False)
        a = [(k, bytes(self.letters[c] for c in t)) for k, t in zip(e.ids, e.tokens, strict=True)]
        b = []
        for k in self.b.encode(text):
            p = self.b.id_to_piece(k)
            b.append((k, bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode()))
        want = (" " + text).encode()
        return (a, b) if b"".join(t for _, t in a) == want == b"".join(t for _, t in b) else ([], [])

    @staticmethod
    def spans(tokens):
        at, out = 0, []
        for k, t in tokens:
            out.append((k, at, at + len(t)))
            at += len(t)
        return out

    def rows(self, docs):
        made, counts = [], Counter()
        for doc_id, text in docs:
            a, b = map(self.spans, self.tokens(text))
            links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
            cuts = sorted({x[2] for x in a} & {y[2] for y in b})
            groups = [",".join(str(x[0]) for x in a if low < x[2] <= high) + "|" + ",".join(str(y[0]) for y in b if low < y[2] <= high) for low, high in zip([0, *cuts], cuts, strict=False)]
            counts.update(set(links))
            made.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
        best = Counter()
        for (x, _), n in counts.items():
            best[x] = max(best[x], n)
        return [(k, na, nb, ng, len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), g) for k, na, nb, ng, links, g in made]


def texts():
    rnd = random.Random(2)
    words = ["the", "alignment", "of", "tokens", "isn't", "naïve", "Straße", "日本語", "12345", "x_y(z)", "antidisestablishmentarianism", "<|endoftext|>", "</s>", "<0x41>", "é", "🙂", "...", "　"]
    odd = [None, "", " ", "  ", "\n", " a", "a ", "a  b", "\ta\n\n b", "▁", "a▁b", "ﬁne ﬂow", "a b", "½", "a\u0000b", "a" * 700, "́", "​"]
    return odd + [rnd.choice(["", " ", "\n"]) + rnd.choice([" ", "  ", "\n", " \n "]).join(rnd.choices(words, k=rnd.randint(1, 25))) for _ in range(120)]


@pytest.mark.parametrize("settings", [{}, {"MAX_PAIRS": 5, "_HELD": 40}])
def test_align(spark, monkeypatch, settings):
    for k, v in settings.items():
        monkeypatch.setattr(align, k, v)
    rows = [*enumerate(texts()), (None, "no id"), (20, "the same id"), (20, "the same id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"pair": F.lit(1), "groups": F.lit(2), "n": F.lit(3), "row": F.lit(4)}).repartition(3)
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(tuple, align.align(docs, A, B).collect()), key=key) == sorted(Plain().rows(rows), key=key)
    assert align.align(docs.limit(0), A, B).count() == 0


def test_a_long_text_without_shared_cuts_inside():
    import pyarrow as pa

    text = "ab" * 3000 + " " + "日" * 2000 + " the end"
    plain = Plain()
    tokens = align.aligner(A, B).tokens(pa.array([None, text, "", "x"]))
    a, b = map(plain.spans, plain.tokens(text))
    a0, b0 = tokens.groups()
    cuts = sorted({x[2] for x in a} & {y[2] for y in b})
    assert tokens.doc.tolist() == [1, 3] and len(a0) == len(cuts) + len({x[2] for x in map(lambda t: t, plain.spans(plain.tokens("x")[0]))} & {y[2] for y in plain.spans(plain.tokens("x")[1])})
    starts = [0, *cuts[:-1]]
    assert [a[k][1] for k in a0[: len(cuts)].tolist()] == starts and [b[k][1] for k in b0[: len(cuts)].tolist()] == starts
