"""SentencePiece encoding and decoding of merge-type (BPE) models by backtracking."""

from __future__ import annotations

import hashlib
import re
import struct
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from exportlens.llm.common import Cache, free_columns, free_name

SPACE = "▁"  # stands for a space inside pieces
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # kinds of pieces in a model file
WINDOW = 2048  # start places whose matches are held at once


@dataclass(frozen=True)
class Model:
    """What a model file says: pieces with score and kind in id order, and whether a space is put in front."""

    pieces: tuple[tuple[str, float, int], ...]
    space_first: bool


def _fields(data: bytes):
    """(number, value) of each field of a protocol-buffer message: ints, bytes, or 4 or 8 raw bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield number, data[at : at + size]
        at += size


def read_model(path: str) -> Model:
    """The model of a file; a ValueError where it is none that this codec encodes exactly.

    Needed are a BPE model with byte pieces for unknown characters, no normalisation but that of
    spaces, spaces kept, and no pieces that a user defined or that are unused.
    """
    with open(path, "rb") as file:
        fields = list(_fields(file.read()))
    trainer = dict(x for number, value in fields if number == 2 for x in _fields(value))
    normal = dict(x for number, value in fields if number == 3 for x in _fields(value))
    pieces = []
    for number, value in fields:
        if number == 1:
            piece = dict(_fields(value))
            pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
    wrong = [name for name, bad in {
        "not of type BPE": trainer.get(3, 1) != 2, "no byte pieces": not trainer.get(35, 0), "spaces as suffixes": trainer.get(24, 0),
        "a character map": normal.get(2, b""), "spaces are merged": normal.get(4, 1), "spaces are not escaped": not normal.get(5, 1),
        "user-defined or unused pieces": any(k not in (NORMAL, UNKNOWN, CONTROL, BYTE) for _, _, k in pieces),
    }.items() if bad]
    if wrong:
        raise ValueError(f"model of an unsupported kind: {', '.join(wrong)}")
    return Model(tuple(pieces), bool(normal.get(3, 1)))


class Codec:
    """Encoder and decoder of one model; no begin or end ids, no sampling.

    The merges of a text always join the adjacent pair whose union has the best score, the leftmost
    of equals. Their result is the one split into pieces in which every two neighbours, merged anew
    from their characters, come out as these two pieces. It is sought from left to right.
    """

    def __init__(self, model: Model):
        self.space_first = model.space_first
        self.kinds = [kind for _, _, kind in model.pieces]
        self.id = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind == NORMAL}
        self.byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(model.pieces) if kind == BYTE}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.order = {p: -score for p, score, kind in model.pieces if kind == NORMAL}
        self.longest = max(map(len, self.id), default=1)
        self.inside = {p[i : i + 2] for p in self.id for i in range(len(p) - 1)}
        # Runs of text that no piece goes beyond: characters of no longer piece stand alone, and a
        # word begins with its spaces where no piece has a space after another character.
        grouped = {c for pair in self.inside for c in pair}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in grouped)
        if any(pair[1] == SPACE != pair[0] for pair in self.inside):
            words = f"[^{alone}]+" if alone else ".+"
        else:
            words = f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+"
        self.runs = re.compile(f"[{alone}]|{words}" if alone else words, re.DOTALL)
        self.automaton = ahocorasick.Automaton()
        for piece in self.id:
            if len(piece) > 1:
                self.automaton.add_word(piece, (piece, len(piece) - 1))
        self.automaton.make_automaton()
        self.fits = Cache(self.fit, limit=400_000)
        self.known = Cache(self.entry, limit=800_000)
        # Text of each id that stands for itself, without regard to its neighbours; others have none.
        self.plain = [piece.replace(SPACE, " ") if kind == NORMAL else None for piece, _, kind in model.pieces]
        self.decimal = [str(i) for i in range(len(model.pieces))]

    def merged(self, text: str) -> list[str]:
        """The merges of a short text, done one by one."""
        parts, get = list(text), self.order.get
        while True:
            best, at = None, 0
            for i in range(len(parts) - 1):
                order = get(parts[i] + parts[i + 1])
                if order is not None and (best is None or order < best):
                    best, at = order, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fit(self, pair: tuple[str | None, str]) -> bool:
        """Whether two neighbours come out of the merges of their characters; a first piece need only do so itself."""
        if pair[0] is None:
            return self.merged(pair[1]) == [pair[1]]
        return tuple(self.merged(pair[0] + pair[1])) == pair

    def matches(self, text: str, begin: int) -> list[list[str]]:
        """For each start place of a window from ``begin``, the pieces that match there, the longest last."""
        size = min(WINDOW, len(text) - begin)
        found = [[c] for c in text[begin : begin + size]]  # a character may have no piece of its own
        for last, (piece, less) in self.automaton.iter(text, begin, min(len(text), begin + size + self.longest)):
            first = last - less - begin
            if first < size:
                found[first].append(piece)
        return found

    def split(self, text: str) -> list[str]:
        """Pieces of a run: the longest match that goes with the piece before, else shorter ones, else back.

        A place from which no piece goes on is marked in a bitfield and never ended at again: a place has only
        one valid split of what lies before it, so one failure shows that the whole split doesn't pass there.
        Hence every place fails once at most and the work is linear in the text.
        """
        size, fits = len(text), self.fits
        failed = bytearray((size >> 3) + 1)
        path: list[str] = []
        tried: list[int] = []  # for each piece of the path, its place among the matches there
        at, begin, window, k = 0, 0, self.matches(text, 0), None
        while at < size:
            if not begin <= at < begin + len(window):
                begin = at - at % WINDOW
                window = self.matches(text, begin)
            options = window[at - begin]
            k = len(options) - 1 if k is None else k
            before = path[-1] if path else None
            while k >= 0:
                piece = options[k]
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1 and fits[before, piece]:
                    break
                k -= 1
            if k >= 0:
                path.append(piece)
                tried.append(k)
                at, k = end, None
            else:
                failed[at >> 3] |= 1 << (at & 7)
                at -= len(path.pop())
                k = tried.pop() - 1
        return path

    def entry(self, run: str) -> tuple[str, str]:
        """Ids of a run, in decimal and joined by commas, and the text that the ids stand for."""
        inside = self.inside
        cuts = [i for i in range(1, len(run)) if run[i - 1 : i + 1] not in inside]
        if cuts:  # no piece spans these places
            parts = [self.known[run[a:b]] for a, b in zip([0, *cuts], [*cuts, len(run)])]
            return ",".join([p[0] for p in parts]), "".join([p[1] for p in parts])
        path = self.split(run)
        ids = [self.id.get(piece) for piece in path]
        if None in ids:
            ids = [i for piece, k in zip(path, ids) for i in ([self.byte[b] for b in piece.encode()] if k is None else [k])]
        return ",".join([self.decimal[i] for i in ids]), self.text_of(ids)

    def entries(self, text: str) -> list[tuple[str, str]]:
        """(ids, text) of the runs of a text, in order."""
        if not text:
            return []
        text = text.replace(" ", SPACE)
        return list(map(self.known.__getitem__, self.runs.findall(SPACE + text if self.space_first else text)))

    def encode(self, text: str) -> list[int]:
        return [int(i) for names, _ in self.entries(text) for i in names.split(",")]

    def text_of(self, ids) -> str:
        """Text of ids, the space in front included; control ids have none, a byte that is no UTF-8 becomes U+FFFD."""
        texts = [self.plain[i] for i in ids]
        if None not in texts:
            return "".join(texts)
        out, waiting = [], bytearray()

        def flush():
            while waiting:
                try:
                    out.append(waiting.decode())
                    waiting.clear()
                except UnicodeDecodeError as e:
                    out.append(waiting[: e.start].decode() + "�")
                    del waiting[: e.start + 1]

        for i in ids:
            if i in self.byte_of:
                waiting.append(self.byte_of[i])
                continue
            flush()
            out.append(" ⁇ " if self.kinds[i] == UNKNOWN else self.plain[i] or "")
        flush()
        return "".join(out)

    def decode(self, ids) -> str:
        """Text of ids without the space that encoding put in front."""
        text = self.text_of(ids)
        return text.removeprefix(" ") if self.space_first else text


_codecs: dict[str, Codec] = {}


def _codec(key: str, model) -> Codec:
    """One codec per worker process and model, kept between tasks."""
    if key not in _codecs:
        _codecs[key] = Codec(model.value)
    return _codecs[key]


def encode_column(df: DataFrame, path: str, text: str = "text", prefix: str = "sp_", keep_ids: bool = False) -> DataFrame:
    """``df`` with ``<prefix>n_tokens``, ``<prefix>ids_sha256`` and ``<prefix>decoded_sha256``, and on request ``<prefix>ids``.

    Each whole text is encoded by the model file at ``path`` and its ids are decoded again. The digests are of the
    decimal ids joined by commas and of the decoded text in UTF-8. A null text counts as empty: no ids,
    digests of nothing. A text of any length is taken whole; words without spaces too, with matches held by windows.
    Rows neither appear nor vanish, and equal rows get equal results; no rows give no rows. Other columns stay, but one named as an
    output is replaced. The model is read by the driver and broadcast; its size doesn't depend on the data.
    """
    own = [T.StructField(f"{prefix}n_tokens", T.LongType()), T.StructField(f"{prefix}ids_sha256", T.StringType()),
           T.StructField(f"{prefix}decoded_sha256", T.StringType())]
    own += [T.StructField(f"{prefix}ids", T.ArrayType(T.IntegerType()))] if keep_ids else []
    stay = free_columns(df, [f.name for f in own])
    read = read_model(path)
    model = df.sparkSession.sparkContext.broadcast(read)
    key = hashlib.sha256(repr(read).encode()).hexdigest()

    def run(batches):
        codec = _codec(key, model)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for batch in batches:
            counts, digests, decoded, lists = [], [], [], []
            for value in batch.column(len(stay)).to_pylist():
                entries = codec.entries(value or "")
                names = ",".join([e[0] for e in entries])
                counts.append(names.count(",") + 1 if names else 0)
                digests.append(digest(names))
                back = "".join([e[1] for e in entries])
                decoded.append(digest(back.removeprefix(" ") if codec.space_first else back))
                if keep_ids:
                    lists.append(list(map(int, names.split(","))) if names else [])
            columns = [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            columns += [pa.array(lists, pa.list_(pa.int32()))] if keep_ids else []
            yield pa.RecordBatch.from_arrays(list(batch.columns)[: len(stay)] + columns, names=stay + [f.name for f in own])

    taken = df.select(*[df[c] for c in stay], df[text].alias(free_name(df, "_text")))
    return taken.mapInArrow(run, T.StructType([df.schema[c] for c in stay] + own))
