"""Rounds of Re-Pair: the same grammars as by counting every pair anew, from fewer pairs."""

from collections import Counter

import numpy as np
import pytest

from wardflow.llm import repair


def _text(seed: int, n: int) -> np.ndarray:
    """Ids with frequent ones, frequent phrases and runs."""
    rng = np.random.default_rng(seed)
    phrases = [rng.zipf(1.3, rng.integers(1, 9)) % 900 for _ in range(400)]
    words = [phrases[k] if k < 400 else rng.zipf(1.2, 3) % 2000 for k in rng.zipf(1.15, n) % 3000]
    return np.concatenate([*words, np.repeat(5, 41), np.arange(30), np.repeat(7, 40)]).astype("<u4")


def _plain(ids: list[int], min_count: int):
    """The rounds pair by pair, over the whole sequence."""
    terminals = sorted(set(ids))
    seq, rules = [terminals.index(i) for i in ids], []
    while True:
        count = Counter(zip(seq, seq[1:]))
        often = sorted((p for p, c in count.items() if c >= min_count), key=lambda p: (-count[p], p))
        side, chosen = {}, {}
        for a, b in often:
            if a == b and a not in side:
                side[a] = "both"
            elif a != b and side.get(a, "left") == "left" and side.get(b, "right") == "right":
                side[a], side[b] = "left", "right"
            else:
                continue
            chosen[a, b] = len(terminals) + len(rules) + len(chosen)
        if not chosen:
            return terminals, rules, seq
        out, i = [], 0
        while i < len(seq):
            new = chosen.get(tuple(seq[i:i + 2]))
            out.append(seq[i] if new is None else new)
            i += 1 if new is None else 2
        seq = out
        rules += chosen


@pytest.mark.parametrize("seed, n, min_count", [(1, 900, 4), (2, 2500, 16), (3, 40, 2), (4, 0, 2)])
def test_same_grammar_as_by_whole_counts(seed, n, min_count):
    ids = _text(seed, n) if n else np.array([3, 3, 3, 3, 3, 1, 3, 3], "<u4")
    terminals, rules, seq = repair.compress(ids, min_count)
    want = _plain(ids.tolist(), min_count)
    assert (terminals.tolist(), [tuple(r) for r in rules.tolist()], seq.tolist()) == want
    block = repair.Block(terminals.tobytes(), rules.tobytes(),
                         repair.expansion_lengths(len(terminals), rules).tobytes(), seq.tobytes())
    assert (block.decode() == ids).all()


def test_pairs_that_share_a_slot():
    codes = np.arange(1 << 18, dtype=np.uint32) * np.uint32(40_503)
    chosen, often = codes[5:200_000:3], codes[2:200_000]
    may, hit, k = repair._find(codes, chosen, often)
    assert hit.tolist() == list(range(5, 200_000, 3)) and (chosen[k] == codes[hit]).all()
    assert may[2:200_000].all()


def test_a_round_counts_only_pairs_that_may_be_frequent(monkeypatch):
    sizes, pick = [], repair._pick

    def counted(codes, *rest):
        sizes.append(len(codes))
        return pick(codes, *rest)
    monkeypatch.setattr(repair, "_pick", counted)
    ids = _text(5, 20_000)
    repair.compress(ids)
    assert len(sizes) > 5 and sizes[0] == len(ids) - 1
    assert sizes[-1] < len(ids) / 100 and sum(sizes) < 3 * len(ids)
