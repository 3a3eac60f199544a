"""Where the public vocabulary files are; a path is a parameter of every operator."""

from __future__ import annotations

import os

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file, the same on every executor."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
