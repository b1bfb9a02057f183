"""The work this library covers has no streams, so there are no streaming operators."""
