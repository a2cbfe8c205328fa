"""Exact, cached encoding of whole texts with the tokenizers library."""

from __future__ import annotations

import os
import re
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wardflow.llm.common import worker_cache

ID = np.dtype("<u4")
# Bits of a byte's kind.  Letters, digits and marks are those whose place in the
# vocabulary's public split pattern no Unicode version changes: ASCII, and the
# letters of Latin-1, which are two bytes beginning with 0xC3.
_LETTER, _DIGIT, _MARK, _QUOTE, _SPACE, _FEED = (1 << i for i in range(6))
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _MARK
for _lo, _hi, _bit in ((0x30, 0x39, _DIGIT), (0x41, 0x5A, _LETTER), (0x61, 0x7A, _LETTER), (0x27, 0x27, _QUOTE), (0x20, 0x20, _SPACE), (0x0A, 0x0A, _FEED)):
    _KIND[_lo:_hi + 1] = _bit
_LATIN, _TIMES, _DIVIDED = 0xC3, 0x97, 0xB7  # the lead byte, and the two of its block that are no letters
_KINDS = _KIND.tobytes()
_BLANK = re.compile(r"\s")
_JOIN = 2000
_LONGEST = 128  # bytes of an atom that is remembered


def _kinds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each byte's kind, and where a Latin-1 letter of two bytes begins."""
    kind = np.frombuffer(data.tobytes().translate(_KINDS), np.uint8)
    lead = data == _LATIN
    lead[:-1] &= (data[1:] != _TIMES) & (data[1:] != _DIVIDED)
    return kind, lead


def _simple(data: np.ndarray, starts: np.ndarray, bits: int = _LETTER | _DIGIT | _MARK | _QUOTE) -> np.ndarray:
    """Which atoms are a space or none, then characters of these kinds and letters only.

    Plain characters of all kinds can be encoded one after another in one text; letters are one pre-token.
    """
    kind, lead = _kinds(data)
    plain = (kind & bits) > 0
    plain |= lead
    plain[1:] |= lead[:-1]
    others = np.add.reduceat(~plain, starts, dtype=np.int64)
    space = kind[starts] == _SPACE
    return (others == space) & (np.diff(starts, append=len(data)) > space)


def _byte_letters() -> np.ndarray:
    """The code points that stand for bytes in byte-level vocabularies; that of the line feed is left as it is."""
    printed = np.r_[0x21:0x7F, 0xA1:0xAD, 0xAE:0x100]
    out = np.zeros(256, "<u4")
    out[printed] = printed
    out[out == 0] = 256 + np.arange(256 - len(printed))
    out[0x0A] = 0x0A
    return out


def atom_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the atoms of UTF-8 texts begin; ``starts`` are the places of the texts in ``data``.

    A cut is made where the split pattern surely ends a pre-token, and never after more than one blank, so that atoms
    encode alone as they do in the text: before a space that a plain character follows; between a
    letter or digit and a mark (not an apostrophe); around a single line feed between plain characters.
    """
    kind, lead = _kinds(data)
    word_start = (kind & (_LETTER | _DIGIT)) > 0
    word_end = word_start.copy()
    word_start |= lead
    word_end[1:] |= lead[:-1]
    plain, mark = (kind & (_MARK | _QUOTE)) > 0, kind == _MARK
    follows = np.zeros(len(data), bool)  # a plain character of the same text comes next
    follows[:-1] = (word_start | plain)[1:]
    ends = starts[starts > 0] - 1
    follows[ends] = False
    cut = (kind == _SPACE) & follows
    cut[1:] |= (mark[1:] & word_end[:-1]) | (word_start[1:] & mark[:-1])
    feed = (kind == _FEED) & follows
    feed[1:] &= (word_end | plain)[:-1]
    feed[0] = False
    cut |= feed
    cut[1:] |= feed[:-1]
    cut[starts[starts < len(data)]] = True
    return np.flatnonzero(cut)


def _expand(flat: np.ndarray, ends: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of entries, one after another, and where each ends; entry k is ``flat[ends[k]:ends[k + 1]]``, never empty."""
    first, last = ends[:-1][entry], ends[1:][entry]
    to = np.cumsum(last - first)
    # steps from one id's place to the next one's: 1 within an entry
    take = np.ones(to[-1] if len(to) else 0, np.int64)
    take[:1] = first[:1]
    take[to[:-1]] = first[1:] - last[:-1] + 1
    return flat[np.cumsum(take, out=take)], to


class PieceEncoder:
    """Encode texts atom by atom with a bounded cache of encoded atoms.

    The ids equal ``Tokenizer.encode(text, add_special_tokens=False)``: where a
    text holds the string of an added token, it is cut there and has that
    token's id.
    """

    def __init__(self, path: str, max_pieces: int = 600_000, max_ids: int = 1 << 22):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        split = self.tok.pre_tokenizer
        if not isinstance(split, pre_tokenizers.ByteLevel) or split.add_prefix_space or not split.use_regex:
            raise ValueError("another pre-tokenizer than the byte-level one with its split pattern")
        # the same merges for pre-tokens that are given one a line, in the letters that stand for bytes
        self.lines = Tokenizer(self.tok.model)
        self.lines.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self.letters = _byte_letters()
        added = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        if self.tok.normalizer or any(t.lstrip or t.rstrip or t.single_word or _BLANK.search(t.content)
                                      for t in self.tok.get_added_tokens_decoder().values()):
            raise ValueError("a normalizer, or added tokens with blanks or conditions around them")
        self.added = added
        longest = sorted(added, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if added else None
        self.max_pieces, self.max_ids = max_pieces, max_ids
        vocab = self.tok.get_vocab(with_added_tokens=True)
        # one character of a byte-level vocabulary entry stands for one byte
        self.n_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for entry, i in vocab.items():
            self.n_bytes[i] = len(entry)
        self._reset()

    def _reset(self) -> None:
        self.cache: dict[bytes, int] = {}       # atom: its entry
        self.flat = np.zeros(0, ID)             # ids of all entries, one after another
        self.ends = np.zeros(1, np.int64)       # of entry k: ends[k]:ends[k + 1]
        self.uses = np.zeros(0, np.int32)       # batches that an entry was found in

    def _forget(self) -> None:
        """Keep the entries of more than one batch if they are few; else start anew."""
        old = np.fromiter(self.cache.values(), np.int64, len(self.cache))
        often = self.uses[old] > 1
        kept = list(compress(self.cache, often.tolist()))
        flat, ends = _expand(self.flat, self.ends, old[often])
        self._reset()
        if 2 * len(kept) < self.max_pieces and 2 * len(flat) < self.max_ids:
            self.cache = dict(zip(kept, range(len(kept))))
            self.flat, self.ends, self.uses = flat, np.r_[0, ends], np.zeros(len(kept), np.int32)

    def _words(self, words: list[bytes]) -> np.ndarray:
        """Ids of words that are one pre-token each, one after another."""
        text = self.letters[np.frombuffer(b"\n".join(words), np.uint8)].tobytes().decode("utf-32-le")
        return np.array(self.lines.encode_batch_fast([text], add_special_tokens=False)[0].ids, ID)

    def _whole(self, text: bytes) -> np.ndarray:
        # the batch call leaves out the places of tokens in the text
        return np.array(self.tok.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, ID)

    def _learn(self, atoms: list[bytes]) -> np.ndarray:
        """Encode atoms and keep them; returns their entries."""
        order, flat, size = self._encode_all(atoms)
        first = len(self.ends) - 1
        self.flat = np.concatenate([self.flat, flat])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(size)])
        self.uses = np.concatenate([self.uses, np.zeros(len(atoms), np.int32)])
        entry = np.empty(len(atoms), np.int64)
        entry[order] = np.arange(first, first + len(atoms))
        self.cache.update(zip(atoms, entry.tolist()))
        for a in atoms:
            if len(a) > _LONGEST:
                del self.cache[a]
        return entry

    def _encode_all(self, atoms: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of the atoms, their ids one after another in it, and how many each has.

        Few library calls: words of letters are given as pre-tokens; other simple atoms that start with a space
        follow each other directly in a text, and each of the rest follows a line feed, whose id is dropped.
        The ids are cut at the atoms' ends.
        """
        length = np.fromiter(map(len, atoms), np.int64, len(atoms))
        data, starts = np.frombuffer(b"".join(atoms), np.uint8), np.cumsum(length) - length
        simple, word, space = _simple(data, starts), _simple(data, starts, _LETTER), data[starts] == ord(" ")
        groups = [(None, np.flatnonzero(word)), (b"", np.flatnonzero(simple & ~word & space)),
                  (b"\n", np.flatnonzero(simple & ~word & ~space))]
        order, ids, size = [], [], []
        alone = [np.flatnonzero(~simple)]
        for lead, group in groups:
            skip = len(self._whole(lead)) if lead else 0
            for k in range(0, len(group), _JOIN):
                part = group[k:k + _JOIN]
                some = [atoms[i] for i in part.tolist()]
                got = self._words(some) if lead is None else self._whole(lead + lead.join(some))
                ends = np.cumsum(self.n_bytes[got])
                cuts = np.cumsum(len(lead or b"") + length[part])
                at = np.searchsorted(ends, cuts)
                if not np.array_equal(ends[at], cuts):  # a token across an atom's end: encode singly
                    alone.append(part)
                    continue
                first = np.r_[0, at[:-1] + 1]
                order.append(part)
                ids.append(np.delete(got, (first[:, None] + np.arange(skip)).ravel()) if skip else got)
                size.append(at + 1 - first - skip)
        singly = np.concatenate(alone)
        each = [self._whole(atoms[i]) for i in singly.tolist()]
        return (np.concatenate([*order, singly]), np.concatenate([np.zeros(0, ID), *ids, *each]),
                np.concatenate([*size, np.fromiter(map(len, each), np.int64, len(each))]))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text starts (one more entry at the end).

        Null counts as empty.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        if not any(pc.any(pc.match_substring(texts, t)).as_py() for t in self.added):
            return self._encode_plain(texts)
        cut = [self.marks.split(t) for t in texts.to_pylist()]  # every other part is an added token
        ids, at = self._encode_plain(pa.array([p for parts in cut for p in parts[::2]], pa.large_string()))
        n_marks = np.array([len(parts) // 2 for parts in cut])
        first = np.cumsum(n_marks + 1) - n_marks - 1  # of each text's segments
        before_mark = np.ones(len(at) - 1, bool)
        before_mark[first + n_marks] = False
        marks = np.array([self.added[p] for parts in cut for p in parts[1::2]], ID)
        ids = np.insert(ids, at[1:][before_mark], marks)
        return ids, np.r_[at[first] + np.cumsum(n_marks) - n_marks, len(ids)]

    def _encode_plain(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of texts without nulls and strings of added tokens.

        Equal atoms of the batch are looked up once; the ids are put together by array indexing.
        """
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        if not len(data):
            return np.zeros(0, ID), np.zeros(len(texts) + 1, np.int64)
        starts = atom_starts(data, offsets[:-1])
        bounds = np.r_[starts, len(data)]
        atoms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        coded = atoms.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # in a fraction of to_pylist's time
        if len(self.cache) > self.max_pieces or len(self.flat) > self.max_ids:
            self._forget()
        entry = np.fromiter(map(self.cache.get, words, repeat(-1)), np.int64, len(words))
        unseen = np.flatnonzero(entry < 0)
        if len(unseen):
            entry[unseen] = self._learn([words[i] for i in unseen.tolist()])
        del words
        self.uses[entry] += 1
        # the ids of the batch's different atoms come first, in one place that is small enough for a processor's cache
        flat, ends = _expand(self.flat, self.ends, entry)
        ids, ends = _expand(flat, np.r_[0, ends], np.asarray(coded.indices))
        return ids, np.r_[0, ends][np.searchsorted(bounds, offsets)]


def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process and vocabulary file."""
    return worker_cache(("encoder", path), lambda: PieceEncoder(path))
