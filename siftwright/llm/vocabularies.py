"""Places of the public vocabulary files. They are read where they are installed and never copied."""

from __future__ import annotations

import public_tokenizers


def word_bpe() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def pieces() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")
