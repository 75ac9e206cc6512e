"""Byte-level BPE by prefix-sharing trie traversal.

The encoding of a prefix ends in exactly one token, and that token with the last
token of what precedes it is enough to encode the prefix. Distinct words are
put into a trie; a depth-first walk hands the last-token states down, so that a
prefix which many words share is encoded once. A word's tokens are read off by
walking back from its end. Two tokens may stand side by side if BPE on their
joined bytes gives them back, which is decided by undoing merges at the seam.

Text is cut before every single space that is followed by something else than
white space, which is always a border of words; each distinct cut is encoded
once per worker and then looked up.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.frames import at_workers, read

#: Fixed value: the word pattern of the byte-level pre-tokenizer.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
CUT = re.compile(r" (?=\S)")
IRREGULAR = re.compile(r" \s")

#: Distinct cuts that a task keeps; beyond that it starts anew. Bounds memory, not results.
KEPT = 500_000
#: Characters of text that are worked on at once.
SLICE = 4_000_000


def byte_of_char() -> dict[str, int]:
    """The byte that each printable stand-in of a byte-level vocabulary means."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in printable}
    return out | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}


ONE = (1,)


class Vocabulary:
    """Tokens by rank: the bytes first, then the merges in the order of the file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            own = json.load(file)
        model, byte = own["model"], byte_of_char()
        names = [c for c in byte]
        self.special = {x["content"]: x["id"] for x in own["added_tokens"]}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        rank = {c: i for i, c in enumerate(names)}
        self.left, self.right = list(range(len(names))), list(range(len(names)))
        self.merged: dict[int, int] = {}
        for a, b in pairs:
            i = len(names)
            self.merged[rank[a] << 20 | rank[b]] = i
            self.left.append(rank[a])
            self.right.append(rank[b])
            names.append(a + b)
            rank[a + b] = i
        self.ids = np.array([model["vocab"][n] for n in names], np.uint32)
        self.id_bytes = [x.tobytes() for x in self.ids]
        self.rank_of = {bytes(byte[c] for c in n): i for i, n in enumerate(names)}
        # how long the tokens are that end in these two bytes, the longest first: only so many need a look at a place
        ending: dict[bytes, set[int]] = {}
        for token in self.rank_of:
            ending.setdefault(token[-2:], set()).add(len(token))
        self.lengths = {end: (*sorted(n | {1}, reverse=True),) for end, n in ending.items() if len(end) == 2}
        spelt = {int(i): b for b, i in zip(self.rank_of, self.ids)} | {i: s.encode() for s, i in self.special.items()}
        self.size = max(spelt) + 1
        self.spelling = [spelt.get(i, b"") for i in range(self.size)]
        self._fits: dict[int, bool] = {}

    def fits(self, a: int, b: int) -> bool:
        """Whether BPE leaves tokens ``a`` and ``b`` (ranks) apart when they stand side by side."""
        key = a << 20 | b
        found = self._fits.get(key)
        if found is None:
            if len(self._fits) > 2_000_000:
                self._fits.clear()
            found = self._fits[key] = self._apart(a, b)
        return found

    def _apart(self, a: int, b: int) -> bool:
        # undo the later of the two merges at the seam; a merge across the seam that comes before it would have won
        bound = len(self.left)
        while True:
            across = self.merged.get(a << 20 | b)
            if across is not None and across < bound:
                return False
            if a > b:
                if self.right[a] != a:
                    bound, a = a, self.right[a]
                elif self.left[b] != b:
                    bound, b = b + 1, self.left[b]
                else:
                    return True
            elif self.left[b] != b:
                bound, b = b + 1, self.left[b]
            elif self.right[a] != a:
                bound, a = a, self.right[a]
            else:
                return True

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids (4 bytes each, little-endian) of every distinct word."""
        rank_of, lengths, fits, known, id_bytes = self.rank_of, self.lengths, self.fits, self._fits, self.id_bytes
        out: dict[str, bytes] = {}
        # sorted words are the leaves of their trie in depth-first order; the lists hold the states of the path to the current node
        path, last, size = b"", [0], [0]
        for raw, word in sorted((w.encode(), w) for w in words):
            shared = 0
            for x, y in zip(path, raw):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :], size[shared + 1 :]
            for end in range(shared + 1, len(raw) + 1):
                for n in lengths.get(raw[end - 2 : end], ONE) if end > 1 else ONE:
                    if n > end:
                        continue
                    start = end - n
                    token = rank_of.get(raw[start:end])
                    if token is None:
                        continue
                    if start:
                        apart = known.get(last[start] << 20 | token)
                        if not (fits(last[start], token) if apart is None else apart):
                            continue
                    last.append(token)
                    size.append(n)
                    break
                else:
                    raise ValueError(f"no encoding of {raw[:end]!r}")
            path, end, tokens = raw, len(raw), []
            while end:
                tokens.append(id_bytes[last[end]])
                end -= size[end]
            out[word] = b"".join(reversed(tokens))
        return out


class Encoder:
    """Texts to ids, with what has been encoded before at hand.

    ``library``: new cuts are encoded by the tiktoken library on the same
    vocabulary and pattern instead of by the trie; the ids are the same.
    """

    def __init__(self, path: str, library: bool = False):
        self.vocabulary = Vocabulary(path)
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.special = re.compile("|".join(map(re.escape, sorted(self.vocabulary.special, key=len, reverse=True)))) if self.vocabulary.special else None
        self.library = None
        if library:
            import tiktoken

            ranks = {b: int(self.vocabulary.ids[r]) for b, r in self.vocabulary.rank_of.items()}
            self.library = tiktoken.Encoding("corpus", pat_str=WORDS.pattern, mergeable_ranks=ranks, special_tokens={})

    def _learn(self, cuts: set[str], known: dict[str, bytes], prefix: str) -> None:
        new = cuts.difference(known)
        if not new:
            return
        if self.library is not None:
            own = self.library.encode_ordinary
            for c in new:
                ids = own(prefix + c)
                known[c] = struct.pack(f"<{len(ids)}I", *ids)
            return
        spelt = {c: WORDS.findall(prefix + c) for c in new}
        words = self.vocabulary.encode_words({w for ws in spelt.values() for w in ws})
        for c, ws in spelt.items():
            known[c] = b"".join([words[w] for w in ws])

    def forget(self) -> None:
        """Drop what has been encoded; workers outlive a task and are shared with other stages."""
        self.first, self.later = {}, {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, 4 bytes each, little-endian; a null text has none."""
        parts: list[tuple[int, list[str] | bytes]] = []
        for i, text in enumerate(texts):
            if not text:
                continue
            pieces = [(text, None)]
            if self.special is not None and self.special.search(text):
                names = [*self.special.findall(text), None]
                pieces = list(zip(self.special.split(text), names))
            for piece, name in pieces:
                if piece:
                    parts.append((i, CUT.split(piece) if IRREGULAR.search(piece) or piece[-1] == " " else piece.split(" ")))
                if name is not None:
                    parts.append((i, self.vocabulary.special[name].to_bytes(4, "little")))
        if len(self.first) + len(self.later) > KEPT:
            self.forget()
        self._learn({p[0] for _, p in parts if isinstance(p, list)}, self.first, "")
        seen: set[str] = set()
        for _, p in parts:
            if isinstance(p, list):
                seen.update(p[1:])
        self._learn(seen, self.later, " ")
        out: list[list[bytes]] = [[] for _ in texts]
        first, later = self.first, self.later
        for i, p in parts:
            if isinstance(p, bytes):
                out[i].append(p)
            else:
                out[i].append(first[p[0]])
                out[i] += map(later.__getitem__, p[1:])
        return [b"".join(x) for x in out]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, library: bool = False) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if (path, library) not in _ENCODERS:
        _ENCODERS[path, library] = Encoder(path, library)
    return _ENCODERS[path, library]


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[list[str | None]]:
    """The texts in lists of about ``most`` characters; a longer text is alone."""
    some, size = [], 0
    for x in texts:
        text = x.as_py()
        some.append(text)
        size += len(text or "")
        if size >= most:
            yield some
            some, size = [], 0
    if some:
        yield some


class Speller:
    """Ids back to decimal text and to bytes, by table."""

    def __init__(self, vocabulary: Vocabulary):
        decimal = [f"{i}," for i in range(vocabulary.size)]
        width = max(map(len, decimal))
        self.decimal = np.frombuffer("".join(d.ljust(width) for d in decimal).encode(), np.uint8).reshape(-1, width)
        self.used = self.decimal != ord(" ")
        self.sizes = np.array([len(b) for b in vocabulary.spelling], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(vocabulary.spelling), np.uint8)

    def decimals(self, ids: np.ndarray) -> bytes:
        return self.decimal[ids][self.used[ids]].tobytes()[:-1]

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' bytes; as in text, what is not UTF-8 becomes U+FFFD."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.flat[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(total)].tobytes()
        return raw.decode("utf-8", "replace").encode()


def _round_trip(path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        speller = Speller(own.vocabulary)
        for batch in batches:
            counts, shas, back = [], [], []
            for texts in slices(batch.column(1)):
                for blob in own.encode(texts):
                    ids = np.frombuffer(blob, "<u4")
                    counts.append(len(ids))
                    shas.append(hashlib.sha256(speller.decimals(ids)).hexdigest())
                    back.append(hashlib.sha256(speller.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        own.forget()

    return rows


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every row. A null text has no ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            ids = [np.frombuffer(b, "<u4").astype(np.int32) for some in slices(batch.column(1)) for b in own.encode(some)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])
        own.forget()

    return _rows(docs, id_col, text_col).mapInArrow(rows, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows of doc_id and ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = Speller(encoder(path).vocabulary)
        for batch in batches:
            texts = [speller.decode(np.array(x.as_py() or [], np.int64)).decode() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(rows, "doc_id long, text string")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    at_workers(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row.

    Defined results: a null text counts as empty and has no ids; repeated rows
    each give a row; an empty table gives an empty result; extra columns are
    ignored. Special tokens spelt out in a text get their own id. Memory
    follows the longest text.
    """
    return _rows(docs, id_col, text_col).mapInArrow(_round_trip(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
