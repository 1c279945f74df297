"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue."""

from __future__ import annotations

import base64
import hashlib
import re
from heapq import heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from exportlens.llm.common import Cache, free_columns, free_name, small_batches

LATIN_END = "\u0250"  # end of the Latin blocks
WORD = 8  # log2 of the bits in one bitmap word
MASK = (1 << WORD) - 1
# Pre-tokens that a worker keeps, some 200 MB; a fourth of them takes some 40 MB and about 1.3 times the CPU.
CACHED = 800_000
# Texts of a batch that are Python strings at a time.
TEXTS = 256


def read_ranks(path: str) -> dict[bytes, int]:
    """Merge ranks of a file with a base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}


def latin_pattern(pattern: str):
    r"""The same pattern for texts below ``LATIN_END``, for the quicker standard module, or None.

    \p{L}, \p{N} and \s become lists of the characters below that end which the general module counts
    among them. A pattern with other classes, or sets inside sets, has none.
    """
    latin = [chr(c) for c in range(ord(LATIN_END))]
    out, at, inside = "", 0, False
    for m in regex.finditer(r"\\p\{[LN]\}|\\[sS]|\\.|[\[\]]", pattern):
        name = m.group()
        out += pattern[at : m.start()]
        at = m.end()
        if name in ("[", "]"):
            if inside == (name == "["):
                return None
            inside = name == "["
            out += name
        elif name == r"\S":
            if inside:
                return None
            out += "[^" + "".join(re.escape(c) for c in latin if regex.match(r"\s", c)) + "]"
        elif name in (r"\p{L}", r"\p{N}", r"\s"):
            chars = "".join(re.escape(c) for c in latin if regex.match(name, c))
            out += chars if inside else f"[{chars}]"
        elif name[1].isalnum():
            return None
        else:
            out += name
    return re.compile(out + pattern[at:])


class Codec:
    """Encoder and decoder for one rank file and one pre-token pattern; no special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cached: int = CACHED):
        self.ranks = ranks
        self.general, self.latin = regex.compile(pattern), latin_pattern(pattern)
        size = max(ranks.values(), default=0) + 1
        self.low = [0] * ((size >> WORD) + 1)  # all 0 between pre-tokens
        self.bit = [1 << i for i in range(max(1 << WORD, len(self.low)))]
        self.token = [b""] * size
        for token, rank in ranks.items():
            self.token[rank] = token
        self.name = [str(i) for i in range(size)]
        # A pre-token's ids are kept as their text: small, and joined once instead of id by id.
        self.known = Cache(lambda piece: " ".join([self.name[i] for i in self.piece(piece.encode())]), limit=cached)
        self.named = {name: self.token[i] for i, name in enumerate(self.name)}

    def piece(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token: always merge the pair of least rank, the leftmost of equals.

        Nodes are start offsets in a doubly linked list; ``rank[i]`` is the rank of node i joined with
        its successor. A bucket per rank holds the offsets of such pairs. A bit of ``low`` marks a
        rank with a bucket, a bit of ``top`` a word of ``low`` with set bits; the first set bit of
        both is the next rank. An entry whose rank is no longer that of its node is stale and skipped.
        """
        ranks, get = self.ranks, self.ranks.get
        whole = get(piece)
        if whole is not None:
            return (whole,)
        end = len(piece)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        rank = [get(piece[i : i + 2]) for i in range(end - 1)]
        rank.append(None)
        low, top, bucket, bit = self.low, 0, {}, self.bit
        for i, r in enumerate(rank):
            if r is None:
                continue
            if r in bucket:
                bucket[r].append(i)  # from left to right, so the list is a heap
            else:
                bucket[r] = [i]
                low[r >> WORD] |= bit[r & MASK]
                top |= bit[r >> WORD]
        while top:
            word = (top & -top).bit_length() - 1
            bits = low[word]
            r = (word << WORD) + (bits & -bits).bit_length() - 1
            waiting = bucket[r]
            if len(waiting) > 1:
                i = heappop(waiting)
            else:
                i = waiting[0]
                del bucket[r]
                low[word] = bits = bits & (bits - 1)
                if not bits:
                    top &= top - 1
            if rank[i] != r:
                continue
            j = after[i]
            k = after[i] = after[j]
            rank[j] = None
            if k < end:
                before[k] = i
                new = get(piece[i : after[k]])
            else:
                new = None
            rank[i] = new
            if new is not None:
                if new in bucket:
                    heappush(bucket[new], i)
                else:
                    bucket[new] = [i]
                    low[new >> WORD] |= bit[new & MASK]
                    top |= bit[new >> WORD]
            h = before[i]
            if h >= 0:
                new = get(piece[h:k])
                if new != rank[h]:
                    rank[h] = new
                    if new is not None:
                        if new in bucket:
                            heappush(bucket[new], h)
                        else:
                            bucket[new] = [h]
                            low[new >> WORD] |= bit[new & MASK]
                            top |= bit[new >> WORD]
        ids, i = [], 0
        while i < end:
            ids.append(ranks[piece[i : after[i]]])
            i = after[i]
        return tuple(ids)

    def find(self, text: str) -> list[str]:
        """The matches of the pattern, in order."""
        if self.general.groups:  # findall would return the groups
            return [m.group() for m in self.general.finditer(text)]
        if self.latin is not None and (text.isascii() or max(text) < LATIN_END):
            return self.latin.findall(text)
        return self.general.findall(text)

    def encode_names(self, text: str) -> str:
        """Ids of a text, in decimal and joined by spaces."""
        return " ".join(map(self.known.__getitem__, self.find(text)))

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.encode_names(text).split()))

    def decode_names(self, names: str) -> bytes:
        """Bytes of ids that are joined by spaces."""
        return b"".join(map(self.named.__getitem__, names.split()))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def texts(column: pa.Array):
    """The texts of a column, a few at a time as Python strings; a batch of long ones is not held twice."""
    for at in range(0, len(column), TEXTS):
        yield from column.slice(at, TEXTS).to_pylist()


_codecs: dict[str, Codec] = {}


def _codec(key: str, ranks, pattern: str, cached: int) -> Codec:
    """One codec per worker process and vocabulary, kept between tasks."""
    if key not in _codecs:
        _codecs[key] = Codec(ranks.value, pattern, cached)
    return _codecs[key]


def encode_column(df: DataFrame, path: str, pattern: str, text: str = "text", prefix: str = "bpe_", keep_ids: bool = False,
                  cached: int = CACHED) -> DataFrame:
    """``df`` with columns ``<prefix>n_tokens``, ``<prefix>ids_sha256`` and ``<prefix>decoded_sha256``, and on request ``<prefix>ids``.

    Each whole text is split by ``pattern`` and every match encoded by the ranks of the file at
    ``path``; the ids are decoded again. The digests are of the decimal ids joined by one space and
    of the decoded bytes. A null text counts as empty: no ids, digests of nothing. A text of any length is
    taken whole. Rows neither appear nor vanish, equal rows get equal results, and no rows give no rows. Other columns
    stay, but one named as an output is replaced. The vocabulary is read by the driver and broadcast; its size
    doesn't depend on the data. ``cached`` bounds the pre-tokens that each worker keeps; it changes no result.
    """
    own = [T.StructField(f"{prefix}n_tokens", T.LongType()), T.StructField(f"{prefix}ids_sha256", T.StringType()),
           T.StructField(f"{prefix}decoded_sha256", T.StringType())]
    own += [T.StructField(f"{prefix}ids", T.ArrayType(T.IntegerType()))] if keep_ids else []
    stay = free_columns(df, [f.name for f in own])
    vocabulary = read_ranks(path)
    ranks = df.sparkSession.sparkContext.broadcast(vocabulary)
    key = hashlib.sha256(repr((sorted(vocabulary.items()), pattern, cached)).encode()).hexdigest()

    def run(batches):
        codec = _codec(key, ranks, pattern, cached)
        for batch in batches:
            counts, digests, decoded, lists = [], [], [], []
            for value in texts(batch.column(len(stay))):
                names = codec.encode_names(value or "")
                counts.append(names.count(" ") + 1 if names else 0)
                digests.append(hashlib.sha256(names.encode()).hexdigest())
                decoded.append(hashlib.sha256(codec.decode_names(names)).hexdigest())
                if keep_ids:
                    lists.append(list(map(int, names.split())))
            columns = [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            columns += [pa.array(lists, pa.list_(pa.int32()))] if keep_ids else []
            yield pa.RecordBatch.from_arrays(list(batch.columns)[: len(stay)] + columns, names=stay + [f.name for f in own])

    taken = df.select(*[df[c] for c in stay], df[text].alias(free_name(df, "_text")))
    return small_batches(taken).mapInArrow(run, T.StructType([df.schema[c] for c in stay] + own))
