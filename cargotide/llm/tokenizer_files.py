"""Where the public tokenizer files are; their folder is never copied here."""

from __future__ import annotations


def byte_bpe() -> tuple[str, str | None, str | None]:
    """Tokenizer JSON, rank file of the same vocabulary, split pattern of the rank file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
