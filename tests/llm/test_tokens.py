"""Atoms of the encoder: learnt many at a time, with the library's ids."""

import random
import re
import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from wardflow.llm import tokens

VOCAB = public_tokenizers.path("byte_bpe_50k.json")


def _calls(run) -> int:
    """Calls that Python makes in ``run``."""
    n = 0

    def count(frame, event, arg):
        nonlocal n
        n += event in ("call", "c_call")
    sys.setprofile(count)
    try:
        run()
    finally:
        sys.setprofile(None)
    return n


def test_new_atoms_take_few_steps_each():
    rng = random.Random(1)
    words = sorted({"".join(rng.choices("abcdeéñß", k=9)) for _ in range(4000)})
    enc = tokens.PieceEncoder(VOCAB)
    texts = pa.array([" ".join(words), "\n".join(words)])
    assert _calls(lambda: enc.encode(texts)) < 3 * 2 * len(words)
    assert _calls(lambda: enc.encode(texts)) < len(words) / 10


@pytest.mark.parametrize("limits", [{}, {"max_pieces": 40, "max_ids": 200}])
def test_odd_atoms_have_the_library_s_ids(limits):
    rng = random.Random(2)
    parts = [" ", " ", "  ", "\n", "\t", "a", "Z", "the", "'s", "'", "9", "!", "-", "é", "ß", "×", "÷", "À", "ÿ", "Ã", "ñ",
             "日", "٣", "²", "İ", "\x85", " ", "\U0001f600", "\x00", "\x7f", "<|endoftext|>", "y" * 300]
    library, enc = Tokenizer.from_file(VOCAB), tokens.PieceEncoder(VOCAB, **limits)
    for _ in range(20):
        texts = [None if rng.random() < 0.05 else "".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(30)]
        ids, at = enc.encode(pa.array(texts, pa.string()))
        for i, t in enumerate(texts):
            assert ids[at[i]:at[i + 1]].tolist() == library.encode(t or "", add_special_tokens=False).ids
    assert all(len(a) <= tokens._LONGEST for a in enc.cache)


def test_simple_atoms():
    atoms = [" a", "a", " ", "  a", "a ", "a b", "\n", "\na", "a\n", "é", " é", "Éa1!", "×", "a÷", "÷a", "ÿ", "À", "Ā", "日",
             "\x7f", "~", "!", "'", " 's", "\x00", "\x85", "a\t", "Ã", "ãa", "Æ×"]
    data = "".join(atoms).encode()
    starts = np.cumsum([0, *(len(a.encode()) for a in atoms[:-1])])
    want = [bool(re.fullmatch("[ ]?[!-~À-ÖØ-öø-ÿ]+", a)) for a in atoms]
    assert tokens._simple(np.frombuffer(data, np.uint8), starts).tolist() == want
