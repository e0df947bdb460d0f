"""Byte-pair encoding over a trie of distinct words, and decoding.

The last token of a word's encoding and the encoding of what is before it make the whole encoding, and the encoding of a
prefix does not depend on what follows. So new words go into a trie, a walk from the root gives every node the last
token of its prefix, and words share the work on shared prefixes. A token may follow another if encoding the two
together gives the two again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The word pattern of byte-level tokenizers, for texts below U+0250, where \p{L} and \p{N} are these.
_LETTER, _NUMBER, _SPACE = r"[^\W\d_²³¹¼½¾]", r"[\d²³¹¼½¾]", r"[\x09-\x0D \x85\xA0]"
_OTHER = r"(?:[^\w\x09-\x0D \x85\xA0]|_)"
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?{_LETTER}+| ?{_NUMBER}+| ?{_OTHER}+|{_SPACE}+(?![^\x09-\x0D \x85\xA0])|{_SPACE}+")
_BEYOND = re.compile("[ɐ-\U0010ffff]")
# Words remembered by a worker: two generations of at most this many each.
REMEMBERED = 200_000
_PAIRS = 500_000
_GROUP_CHARS = 1 << 18


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free one from U+0100."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or (b >= 0xA1 and b != 0xAD)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _described(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def token_bytes(described: dict) -> list[bytes]:
    """What each id stands for; added tokens stand for their own text."""
    alphabet = byte_alphabet()
    added = {t["content"]: t["id"] for t in described["added_tokens"]}
    ids = described["model"]["vocab"] | added
    found = [b""] * (1 + max(ids.values(), default=-1))
    for token, i in ids.items():
        found[i] = token.encode() if token in added else bytes(alphabet[c] for c in token)
    return found


class Vocabulary:
    """A byte-level vocabulary: tokens as bytes, and which token may follow which."""

    def __init__(self, path: str):
        described = _described(path)
        model, split = described["model"], described["pre_tokenizer"] or {}
        if (described["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space")
                or not split.get("use_regex") or model.get("ignore_merges") or model.get("end_of_word_suffix")):
            raise ValueError(f"{path} is not a plain byte-level vocabulary")
        ids = model["vocab"]
        self.added = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.bytes = token_bytes(described)
        self.ids = {self.bytes[i]: i for t, i in ids.items() if t not in self.added}
        # pair of tokens -> rank, and token -> its two parts
        self.rank, self.parts = {}, {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            whole = ids[left + right]
            if whole in self.parts:
                raise ValueError(f"two merges make {left + right!r}")
            self.rank[ids[left], ids[right]] = rank
            self.parts[whole] = ids[left], ids[right]
        self._edges: tuple[dict, dict] = ({}, {})
        self._follows: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}
        self.suffixes = self._suffix_trie()

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that stand at one edge of ``token`` while it is put together, and the rank that ends each."""
        known = self._edges[side]
        if token not in known:
            parts = self.parts.get(token)
            inner = [] if parts is None else self._edge(parts[side], side)
            if inner:
                inner = [*inner[:-1], (inner[-1][0], self.rank[parts])]
            known[token] = [*inner, (token, float("inf"))]
        return known[token]

    def _merge_across(self, left: int, right: int, final: bool) -> bool:
        """Whether some merge joins the two before they are complete, or (unless ``final``) when they are.

        Merges go by rank, equal ones from the left: a token that its left neighbour takes at the same rank is gone, one
        that its right neighbour takes is still there.
        """
        rank = self.rank
        for x, x_ends in self._edge(left, 1):
            for y, y_ends in self._edge(right, 0):
                r = rank.get((x, y))
                if r is not None and r < x_ends and r <= y_ends and not (final and x == left and y == right):
                    return True
        return False

    def is_whole(self, token: int) -> bool:
        """Whether the token's bytes are encoded as the token."""
        if token not in self._whole:
            parts = self.parts.get(token)
            self._whole[token] = parts is None and len(self.bytes[token]) == 1 or parts is not None and (
                self.is_whole(parts[0]) and self.is_whole(parts[1]) and not self._merge_across(*parts, True))
        return self._whole[token]

    def may_follow(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self._follows.get(key)
        if known is None:
            if len(self._follows) > _PAIRS:
                self._follows.clear()
            known = self._follows[key] = not self._merge_across(left, right, False)
        return known

    def _suffix_trie(self) -> dict:
        """The tokens that are encoded as themselves, by their bytes read backwards; -1 marks a token."""
        trie: dict = {}
        for data, token in self.ids.items():
            if self.is_whole(token):
                node = trie
                for byte in reversed(data):
                    node = node.setdefault(byte, {})
                node[-1] = token
        return trie

    def last_token(self, path: bytes | bytearray, n: int, last: list[int]) -> int:
        """The last token of the encoding of the first ``n`` bytes; ``last`` has those of shorter prefixes, by length."""
        node, at, candidates = self.suffixes, n, []
        while at > 0:
            at -= 1
            node = node.get(path[at])
            if node is None:
                break
            token = node.get(-1)
            if token is not None:
                candidates.append((token, at))
        follows = self._follows
        for token, at in reversed(candidates):
            if not at:
                return token
            known = follows.get(last[at] << 32 | token)
            if known or (known is None and self.may_follow(last[at], token)):
                return token
        raise ValueError(f"the vocabulary has no token for byte {path[n - 1]}")

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """The ids of each word, by one depth-first walk over the trie of all of them.

        A branch that only one word takes is not unrolled: its node is the word itself.
        """
        trie: dict = {}
        for word in words:
            _insert(trie, word)
        found, path, last, last_token = {}, bytearray(), [-1], self.last_token
        walk = [iter(trie.items())]
        while walk:
            for byte, node in walk[-1]:
                depth = len(path)
                if type(node) is bytes:
                    for n in range(depth + 1, len(node) + 1):
                        last.append(last_token(node, n, last))
                    found[node] = self._unwind(last)
                    del last[depth + 1:]
                else:
                    path.append(byte)
                    last.append(last_token(path, depth + 1, last))
                    walk.append(iter(node.items()))
                    break
            else:
                walk.pop()
                if walk:
                    path.pop()
                    last.pop()
        return found

    def _unwind(self, last: list[int]) -> list[int]:
        """The whole encoding, read backwards from the last token."""
        ids, at = [], len(last) - 1
        while at > 0:
            ids.append(last[at])
            at -= len(self.bytes[last[at]])
        return ids[::-1]


def _insert(trie: dict, word: bytes) -> None:
    node, depth = trie, 0
    while depth < len(word):
        byte = word[depth]
        below = node.get(byte)
        depth += 1
        if below is None:
            node[byte] = word
            return
        if type(below) is bytes:
            if below == word:
                return
            node[byte] = below = {below[depth] if len(below) > depth else -1: below}
        node = below
    node[-1] = word


class Coder:
    """Encodes and decodes texts with one vocabulary; remembers the words it has met."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.vocabulary = Vocabulary(path)
        self.split_beyond = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.added = re.compile("|".join(map(re.escape, sorted(self.vocabulary.added, key=len, reverse=True))) or "(?!)")
        self.added_starts = sorted({token[0] for token in self.vocabulary.added})
        self.remembered = remembered
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """The words of a text without added tokens. Beyond U+0250 the library says what is a letter."""
        if _BEYOND.search(text):
            return [text[a:b] for _, (a, b) in self.split_beyond(text)]
        return _WORDS.findall(text)

    def pieces(self, text: str) -> list[str]:
        """Words and added tokens in order."""
        if not any(c in text for c in self.added_starts) or not self.added.search(text):
            return self.words(text)
        out, at = [], 0
        for m in self.added.finditer(text):
            out += self.words(text[at:m.start()])
            out.append(m.group())
            at = m.end()
        return out + self.words(text[at:])

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian 32-bit numbers, in order."""
        group, size = [], 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= _GROUP_CHARS:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> Iterator[bytes]:
        split = [self.pieces(t) for t in texts]
        parts = [list(map(self.recent.get, p)) for p in split]
        gaps = [[i for i, x in enumerate(ps) if x is None] if None in ps else () for ps in parts]
        if unknown := {words[i] for words, at in zip(split, gaps) for i in at}:
            self._learn(unknown)
        for words, ps, at in zip(split, parts, gaps):
            for i in at:
                ps[i] = self.recent[words[i]]
            yield b"".join(ps)
        if len(self.recent) > self.remembered:
            self.older, self.recent = self.recent, {}

    def _learn(self, words: set[str]) -> None:
        new = {}
        for word in words:
            if (ids := self.older.get(word)) is not None:
                self.recent[word] = ids
            elif word in self.vocabulary.added:
                self.recent[word] = self.vocabulary.added[word].to_bytes(4, "little")
            else:
                new[word.encode()] = word
        for data, ids in self.vocabulary.encode_words(new).items():
            self.recent[new[data]] = np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=4)
def coder(path: str) -> Coder:
    """The worker's coder of a file: the remembered words outlive a task."""
    return Coder(path)


@lru_cache(maxsize=4)
def decoder(path: str) -> list[bytes]:
    """All that decoding needs; its workers do not hold the tables of the encoder."""
    return token_bytes(_described(path))


def decode_ids(ids: bytes, tokens: list[bytes]) -> str:
    """The text of little-endian 32-bit ids; bytes that are no UTF-8 become replacement characters."""
    return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def encode(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and ids (little-endian, 32 bits) of every row's whole text.

    Null text counts as empty and gives no ids. Strings of added tokens in a text become those tokens, as in the
    tokenizers library. Repeated rows give repeated rows, a null doc_id is carried along, other columns are not read.
    """
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = coder(vocabulary)
        for batch in batches:
            ids = pa.array(words.encode_all(x.as_py() for x in batch.column(1)), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return source.mapInArrow(run, source.select("doc_id", F.lit(b"").alias("ids")).schema)


def decode(coded: DataFrame, vocabulary: str) -> DataFrame:
    """Adds the column text to rows with the column ids; null ids give null."""
    names = coded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = decoder(vocabulary)
        for batch in batches:
            ids = batch.column(names.index("ids"))
            texts = pa.array((decode_ids(x.as_py(), tokens) if x.is_valid else None for x in ids), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*names, "text"])

    return coded.mapInArrow(run, coded.withColumn("text", F.lit("")).schema)
