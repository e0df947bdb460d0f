"""Token ids of whole texts, as the tokenizers library gives them.

Most words of a corpus occur again and again. Where a tokenizer drops white space, a text's ids are those of its
space-separated chunks in order, so a chunk is encoded by the library once per worker and then remembered.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Chunks lie between ASCII white space: no match of the word pattern spans it, and nothing composes across it.
# Letters below U+0250, or whatever lies between them, for chunks without apostrophes, marks and İ (a mark in lower case).
_RUN = re.compile(r"[^\W\d_²³¹¼½¾]+|(?:[\d_²³¹¼½¾]|[^\w\x20\x09-\x0D])+")
_WHOLE = re.compile(r"['İɐ-\U0010ffff]|<\|")
# The parts of a tokenizer file under which chunks are independent.
_DROPPED_SPACE = re.compile(r"\[\^\\s\\p\{L\}\\p\{N\}\]\+$")
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
# Chunks remembered by a worker: two generations of at most this many each.
REMEMBERED = 600_000
_GROUP_BYTES = 1 << 17


class Encoder:
    """Encodes texts with one tokenizer file (truncation and padding off, no special tokens added)."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.size = size
        self.remembered = remembered
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.by_chunk, suffix = _independent_chunks(described)
        # The same model for words of lower-case letters only, to which the file's other steps do nothing.
        described |= {"normalizer": None, "added_tokens": [], "truncation": None, "padding": None, "pre_tokenizer": {
            "type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, _BYTE_LEVEL]}}
        self.words_only = Tokenizer.from_str(json.dumps(described)) if self.by_chunk else None
        ends = np.zeros(size, bool)
        if suffix:
            for token, i in self.library.get_vocab(with_added_tokens=True).items():
                ends[i] = token.endswith(suffix)
        self.ends = ends

    def encode(self, text: bytes | None) -> np.ndarray:
        """The ids of one whole text in UTF-8; null counts as empty."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[bytes | None]) -> Iterator[np.ndarray]:
        """The ids of each text, in order. Texts are taken in groups of about a hundred kilobytes."""
        group, size = [], 0
        for text in texts:
            group.append(text or b"")
            size += len(group[-1])
            if size >= _GROUP_BYTES:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        if not self.by_chunk:
            for e in self.library.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False):
                yield np.array(e.ids, self.dtype)
            return
        # bytes.split() splits at ASCII white space and nothing else.
        chunks = [t.split() for t in texts]
        parts = [list(map(self.recent.get, c)) for c in chunks]
        gaps = [[i for i, p in enumerate(ps) if p is None] if None in ps else () for ps in parts]
        if unknown := {cs[i] for cs, at in zip(chunks, gaps) for i in at}:
            self._learn(unknown)
        for cs, ps, at in zip(chunks, parts, gaps):
            for i in at:
                ps[i] = self.recent[cs[i]]
            yield np.frombuffer(b"".join(ps), self.dtype)
        if len(self.recent) > self.remembered:
            self.older, self.recent = self.recent, {}

    def _learn(self, chunks: set[bytes]) -> None:
        """Ids of chunks not met since two generations, from the library."""
        recent, older = self.recent, self.older
        runs, known, words, rest, whole = {}, {}, set(), set(), []
        for chunk in chunks:
            if (ids := older.get(chunk)) is not None:
                recent[chunk] = ids
                continue
            text = chunk.decode()
            if _WHOLE.search(text):
                whole.append(text)
                continue
            # The tokenizer makes the runs lower case; so may we, and meet more that are known.
            runs[chunk] = pieces = (text.lower(),) if text.isalpha() else _RUN.findall(text.lower())
            for piece in pieces:
                if piece not in known and piece not in words and piece not in rest:
                    key = piece.encode()
                    ids = recent.get(key) or older.get(key)
                    if ids is not None:
                        known[piece] = ids
                    else:
                        (words if piece.isalpha() else rest).add(piece)
        new = self._words(list(words)) | self._one_by_one(list(rest))
        for piece, ids in new.items():
            recent[piece.encode()] = ids
        known |= new
        for text, ids in self._one_by_one(whole).items():
            recent[text.encode()] = ids
        for chunk, pieces in runs.items():
            recent[chunk] = known[pieces[0]] if len(pieces) == 1 else b"".join([known[p] for p in pieces])

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Words of letters in one call: each one's last id is an end-of-word token."""
        if not words:
            return {}
        [joined] = self.words_only.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(joined.ids, self.dtype)
        after = np.flatnonzero(self.ends[ids]) + 1
        if len(after) != len(words) or after[-1] != len(ids):
            return self._one_by_one(words)
        data, width = ids.tobytes(), self.dtype.itemsize
        after = (after * width).tolist()
        return {w: data[a:b] for w, a, b in zip(words, [0, *after], after)}

    def _one_by_one(self, chunks: list[str]) -> dict[str, bytes]:
        found = {}
        for at in range(0, len(chunks), 1000):
            some = chunks[at:at + 1000]
            for chunk, e in zip(some, self.library.encode_batch_fast(some, add_special_tokens=False)):
                found[chunk] = np.array(e.ids, self.dtype).tobytes()
        return found


def _independent_chunks(file: dict) -> tuple[bool, str]:
    """Whether the chunks of a text can be encoded one by one, and the end-of-word suffix."""
    normalizer, split = file.get("normalizer") or {}, file.get("pre_tokenizer") or {}
    normalizers = normalizer.get("normalizers", [normalizer] if normalizer else [])
    splits = split.get("pretokenizers", [split] if split else [])
    first = splits[0] if splits else {}
    drops_space = (first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert"))
                   and bool(_DROPPED_SPACE.search(first.get("pattern", {}).get("Regex", ""))))
    rest_is_bytes = [{**_BYTE_LEVEL, **s, "trim_offsets": True} for s in splits[1:]] == [_BYTE_LEVEL]
    simple = [n.get("type") for n in normalizers] == _NORMALIZERS and normalizers[1]["pattern"] == {"Regex": r"\s+"}
    plain_added = all(not t.get("lstrip") and not t.get("rstrip") and not t.get("single_word")
                      and t["content"].startswith("<|") and not _space(t["content"]) for t in file["added_tokens"])
    suffix = file["model"].get("end_of_word_suffix") or ""
    return drops_space and rest_is_bytes and simple and plain_added and bool(suffix), suffix


def _space(text: str) -> bool:
    return any(c.isspace() for c in text)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The worker's encoder of a file: the remembered chunks outlive a task."""
    return Encoder(path)
