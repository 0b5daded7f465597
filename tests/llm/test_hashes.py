import re

import numpy as np

from closeledger.llm.hilbert import hilbert_index
from closeledger.llm.words import shingle_set, shingle_strings, word_hashes


def test_words_and_shingles_match_plain_python():
    for text in ("", " ", "One", "a b c", "A b\tc\nd e f a b c d e f", "É é x y z  w \x0b\x0c v", "w " * 50):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets = {" ".join(words[i : i + 5]).encode() for i in range(max(1, len(words) - 4))} if words else set()
        assert len(word_hashes(text)) == len(words)
        assert len(set(word_hashes(text).tolist())) == len(set(words))
        assert shingle_strings(text) == sets
        assert len(shingle_set(text)) == len(sets)
    assert set(shingle_set("x a b c d e y").tolist()) & set(shingle_set("A B C D E").tolist())


def test_hilbert_curve_visits_every_cell_by_unit_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        index = hilbert_index(grid, bits)
        assert sorted(index.tolist()) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()
