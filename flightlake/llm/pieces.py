"""A unigram vocabulary read from a sentencepiece model file: pieces with scores."""

from __future__ import annotations

import numpy as np

#: Fixed value: the mark that stands for the space before a word.
SPACE = "▁"


def load_pieces(path: str) -> tuple[list[str], np.ndarray]:
    """Ordinary pieces of the file and their scores (no control, unknown or byte pieces)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    keep = [i for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return [sp.id_to_piece(i) for i in keep], np.array([sp.get_score(i) for i in keep], dtype=np.float64)
