"""Jobs that were once done in part: long texts, row identity, whole grammars, added tokens."""

from __future__ import annotations

import base64
import random

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from wardflow.llm import quality, repair
from wardflow.llm.tokens import PieceEncoder

LARGER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def good():
    """Distinct texts labelled good, by language."""
    rows = duckdb.execute(f"SELECT lang, text FROM '{LARGER}/documents.parquet' JOIN '{LARGER}/labels.parquet' USING (doc_id) "
                          "WHERE quality = 1 ORDER BY doc_id").fetchall()
    out: dict[str, list[str]] = {}
    for lang, text in dict.fromkeys(rows):
        out.setdefault(lang, []).append(text)
    return out


@pytest.mark.parametrize("size", [100_000, 130_000, 300_000, 600_000, 1_000_000])
def test_long_clean_texts_stay_in_band(good, size):
    judge = quality._judge(quality.Bands())
    assert sorted(good) == ["de", "en", "es", "fr"]
    for lang, texts in good.items():
        text = "\n".join(texts).encode()[:size].decode(errors="ignore")
        assert size > 700_000 or len(text.encode()) > size - 4
        row = judge(0, text)
        assert not row[9], (lang, len(text), row[7])
        assert judge(0, text + text)[9]  # a long copy is still out of band


def test_longest_clean_document_is_kept():
    text = duckdb.execute(f"SELECT text FROM '{LARGER}/documents.parquet' WHERE doc_id = 634").fetchone()[0]
    assert len(text.encode()) > 130_000 and quality._judge(quality.Bands())(634, text)[-1]


@pytest.mark.parametrize("size", [40_000, 200_000, 600_000])
@pytest.mark.parametrize("at", [0.0, 0.37, 1.0])
def test_block_of_noise_fails_at_any_length(good, size, at):
    judge = quality._judge(quality.Bands())
    raw = base64.b64encode(random.Random(4).randbytes(9300)).decode()
    noise = " ".join(raw[i:i + 9] for i in range(0, len(raw), 9))[:12_287]
    assert len(noise) == 12_287
    for texts in good.values():
        prose = "\n".join(texts)[:size]
        cut = int(at * len(prose))
        assert judge(0, prose[:cut] + noise + prose[cut:])[9]


def test_grammar_has_no_frequent_pair_left():
    rng = np.random.default_rng(6)
    # 120 pairs of 20 occurrences each in noise: together under 2 % of the sequence in any round
    ids = rng.permutation(np.repeat(np.arange(300, 50_000, dtype="<u4"), 4))
    for k in range(120):
        at = rng.integers(0, len(ids) - 1, 20)
        ids[at], ids[at + 1] = 2 * k, 2 * k + 1
    terminals, rules, seq = repair.compress(ids)
    _, count = np.unique(seq[:-1].astype(np.int64) << 32 | seq[1:], return_counts=True)
    assert count.max() < 16 and len(rules) >= 100
    block = repair.Block(terminals.tobytes(), rules.tobytes(),
                         repair.expansion_lengths(len(terminals), rules).tobytes(), seq.tobytes())
    assert (block.decode() == ids).all()
    assert (block.decode(777, 5_000) == ids[777:5_000]).all()


def test_range_decoding_expands_only_the_range():
    # 2^31 ids in 31 symbols: cannot be opened by expanding the rules
    rules = np.array([(0, 1)] + [(k, k) for k in range(2, 32)], "<u4")
    lengths = repair.expansion_lengths(2, rules)
    block = repair.Block(np.array([7, 9], "<u4").tobytes(), rules.tobytes(), lengths.tobytes(),
                         np.array([32], "<u4").tobytes())
    assert len(block) == 1 << 31
    assert block.decode((1 << 30) - 1, (1 << 30) + 4).tolist() == [9, 7, 9, 7, 9]
    assert block.decode((1 << 31) - 2, 1 << 31).tolist() == [7, 9]


def test_added_tokens_as_in_the_library():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, enc = Tokenizer.from_file(path), PieceEncoder(path)
    rng = random.Random(7)
    mark = "<|endoftext|>"
    bits = [mark, mark, "<|endoftext|", "|>", "<", " ", "  ", "\n", "a", "the", "Ünder", "12", "'s", "日本", "\x85"]
    texts = [f"a {mark} b", mark, mark * 3, f" {mark}", None, "", "plain text", f"x{mark}"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(400)]
    for some in (texts, texts[4:7], texts[:1], []):
        ids, at = enc.encode(pa.array(some, pa.string()))
        want = [library.encode(t or "", add_special_tokens=False).ids for t in some]
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want
    assert enc.encode(pa.array(texts[:1]))[0].tolist() == [64, 220, 50256, 275]


def _prose(seed: int, n: int = 120) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("etaoinshrdlu") for _ in range(6)) for _ in range(n)]


def _near(words: list[str]) -> list[str]:
    return [*words[:-1], "changed"]


def test_pipeline_judges_rows_not_ids(spark, frame, tmp_path):
    p, q, r, s = (" ".join(_prose(i)) for i in range(4))
    near = {i: " ".join(_near(_prose(i))) for i in range(4)}
    rows = [(None, p), (None, p), (None, p + "\n"), (None, p.replace(" ", "\n", 1)),  # exact copies without an id
            (None, near[0]),
            (5, near[1]), (7, q), (7, r), (9, near[2]),  # 5 takes q of 7, but not r
            (8, s), (8, s), (8, near[3])]
    docs = frame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id BIGINT, text STRING, n INT")
    corpus_pipeline.exact_dedup(spark, docs, "").write.parquet(f"{tmp_path}/exact")
    exact = spark.read.parquet(f"{tmp_path}/exact")
    got = sorted((r.n for r in exact.collect()))
    assert exact.columns == ["doc_id", "text", "n"]
    assert len([n for n in got if n < 4]) == 1 and 2 in got  # the longest original
    assert [n for n in got if 4 <= n < 9] == [4, 5, 6, 7, 8] and len([n for n in got if 9 <= n <= 10]) == 1 and 11 in got
    left = [r.n for r in corpus_pipeline.near_dedup(spark, exact, "").collect()]
    assert len(left) == len(set(left)) == 4
    assert len({2, 4} & set(left)) == 1 and {5, 7} <= set(left) and not {6, 8} & set(left)
    assert len({9, 10, 11} & set(left)) == 1


def test_pipeline_rows_with_clear_ids_are_not_numbered(frame):
    seen = []
    docs = frame([(1, "a"), (2, "a")])
    corpus_pipeline.by_row(docs, lambda d: seen.append(d) or d)
    assert seen == [docs]
