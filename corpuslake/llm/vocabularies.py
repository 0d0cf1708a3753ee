"""Places of the public tokenizer files; any path can be passed instead."""

import public_tokenizers


def byte_bpe() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")
