"""SentencePiece merge-type encoding by backtracking, and decoding.

Merging pairs by score gives a unique result, and a token sequence is that result exactly when
re-merging each adjacent pair of its tokens gives the pair back. So the encoder reads longest matches
from an Aho-Corasick automaton, keeps a token only beside a compatible one, falls back to shorter
matches, and marks positions from which nothing fits in a bitfield, so none is tried twice.

No piece of such a model has the space mark after another character, hence no merge crosses a place
where a space begins: the text is cut there and equal cuts are encoded once. A model for which
this does not hold, or with unused pieces, is refused.

Definitions: null and empty texts give the begin and end ids alone. Ids travel as little-endian
unsigned 32-bit integers in a binary column. Decoding unknown ids gives " ⁇ ", control ids
nothing, and each byte of an invalid run of byte pieces one replacement character.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator, Sequence
from functools import cached_property

import ahocorasick
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.llm.common import CACHES, lean, own_names

MARK = "▁"
CACHED_CUTS = 1 << 17  # entries of a generation; a worker keeps the newer and the older one
OUT_ROWS = 256  # in a batch that leaves a task
CACHED_PAIRS = 1 << 19  # neighbours whose compatibility a worker keeps
CACHED_LENGTH = 48  # longer cuts are encoded each time
_ALONE = [1]  # lengths where nothing but the code point itself matches
_CUT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class _Cuts(dict):
    """Packed ids by cut, filled on demand; the entries used last stay in two generations."""

    def __init__(self, codec: PieceCodec):
        self.codec = codec
        self.older: dict[str, bytes] = {}

    def __missing__(self, cut: str) -> bytes:
        packed = self.older.get(cut)
        if packed is None:
            ids = self.codec.cut_ids(cut)
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(cut) <= CACHED_LENGTH:
            if len(self) >= CACHED_CUTS:
                self.older = dict(self)
                self.clear()
            self[cut] = packed
        return packed


class PieceCodec:
    """Encoder and decoder of one serialized model."""

    def __init__(self, model: bytes):
        spm = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = spm.vocab_size()
        self.bos, self.eos, self.unknown = spm.bos_id(), spm.eos_id(), spm.unk_id()
        self.byte_ids: dict[int, int] = {}
        self.controls: set[int] = set()
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.surface: list[bytes] = []
        for i in range(size):
            piece = spm.id_to_piece(i)
            if spm.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif spm.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            elif spm.is_control(i):
                self.controls.add(i)
                self.surface.append(b"")
            elif spm.is_unused(i):
                raise ValueError("models with unused pieces are not supported")
            else:
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {i} crosses a space")
                self.ids[piece] = i
                self.scores[piece] = spm.get_score(i)
                self.surface.append(piece.replace(MARK, " ").encode())
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.cuts = _Cuts(self)

    @cached_property
    def matcher(self) -> ahocorasick.Automaton:
        """Of the pieces of two code points or more that merging can make; built where texts are encoded."""
        found = ahocorasick.Automaton()
        for piece in self.ids:
            if len(piece) > 1 and len(self.merged(piece)) == 1:
                found.add_word(piece, len(piece))
        found.make_automaton()
        return found

    def merged(self, text: str) -> list[str]:
        """Best-scored pair first, leftmost among equals."""
        parts = list(text)
        while True:
            best, at = None, 0
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merged(left + right) == [left, right]
        return known

    def cut_tokens(self, text: str) -> list[str]:
        """Tokens of a text without inner spaces."""
        n = len(text)
        lengths: list[list[int]] = [_ALONE] * n
        for end, length in self.matcher.iter(text):
            start = end - length + 1
            if lengths[start] is _ALONE:
                lengths[start] = [1, length]  # ends ascend, so lengths do
            else:
                lengths[start].append(length)
        pairs = self.pairs
        failed = bytearray((n >> 3) + 1)
        tokens: list[str] = []
        tried: list[int] = []  # for each chosen token, how many shorter matches are left
        pos, last, left = 0, None, len(lengths[0]) if n else 0
        while pos < n:
            here = lengths[pos]
            while left:
                left -= 1
                end = pos + here[left]
                if failed[end >> 3] >> (end & 7) & 1:
                    continue
                token = text[pos:end]
                if last is not None:
                    fits = pairs.get((last, token))
                    if not (self.compatible(last, token) if fits is None else fits):
                        continue
                tokens.append(token)
                tried.append(left)
                pos, last = end, token
                left = len(lengths[pos]) if pos < n else 0
                break
            else:
                failed[pos >> 3] |= 1 << (pos & 7)
                pos -= len(tokens.pop())
                last = tokens[-1] if tokens else None
                left = tried.pop()
        return tokens

    def cut_ids(self, cut: str) -> list[int]:
        found = self.ids.get(cut)
        if found is not None and self.matcher.exists(cut):
            return [found]
        ids: list[int] = []
        for token in self.cut_tokens(cut):
            found = self.ids.get(token)
            if found is not None:
                ids.append(found)
            elif self.byte_ids:
                ids.extend(map(self.byte_ids.__getitem__, token.encode()))
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return ids

    def encode(self, text: str | None, ends: bool = True) -> bytes:
        """Packed ids of a whole text, between begin and end ids where ``ends``."""
        body = b""
        if text:
            escaped = MARK + text.replace(" ", MARK)
            body = b"".join(map(self.cuts.__getitem__, _CUT.findall(escaped)))
        return struct.pack("<I", self.bos) + body + struct.pack("<I", self.eos) if ends else body

    def decode(self, ids: Sequence[int]) -> str:
        if ids and ids[0] == self.bos:
            ids = ids[1:]
        if ids and ids[-1] == self.eos:
            ids = ids[:-1]
        if not self.controls.isdisjoint(ids):  # they part runs of byte pieces
            return self._decode_runs(ids)
        joined = b"".join(map(self.surface.__getitem__, ids))
        head = ids[0] if ids else None
        if head is not None and head not in self.byte_of and head != self.unknown:
            joined = joined.removeprefix(b" ")
        try:
            return joined.decode()
        except UnicodeDecodeError:
            return self._decode_runs(ids)

    def _decode_runs(self, ids: Sequence[int]) -> str:
        out: list[str] = []
        run = bytearray()
        first = True

        def flush() -> None:
            at = 0
            while at < len(run):
                for width in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at : at + width]).decode())
                        at += width
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            run.clear()

        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                first = False
            elif i in self.controls:
                flush()
            else:
                flush()
                piece = self.surface[i].decode()
                out.append(piece.removeprefix(" ") if first and i != self.unknown else piece)
                first = False
        flush()
        return "".join(out)


_CODECS: dict[bytes, PieceCodec] = CACHES.setdefault("codecs", {})


def codec(model: bytes) -> PieceCodec:
    """One codec for each model in a worker, so its caches outlive a task."""
    if model not in _CODECS:
        _CODECS.clear()
        _CODECS[model] = PieceCodec(model)
    return _CODECS[model]


def load_model(path: str) -> bytes:
    """The model file, read where the job is planned; its size (under 64 MB) goes with the tasks."""
    with open(path, "rb") as file:
        model = file.read()
    if len(model) > 64 << 20:
        raise ValueError("the model is too large to be sent with tasks")
    return model


def encode(text: Column | str, model: bytes, ends: bool = True) -> Column:
    """Packed ids of a text column; null counts as empty."""

    @F.pandas_udf("binary")
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(model)
        for batch in lean(batches, "codecs"):
            yield pd.Series([own.encode(x, ends) for x in batch], dtype=object)

    return packed(text)


def decode(ids: Column | str, model: bytes) -> Column:
    """Text of packed ids; null gives an empty text."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(model)
        for batch in lean(batches, "codecs"):
            yield pd.Series(
                [own.decode(struct.unpack(f"<{len(x) >> 2}I", x)) if x else "" for x in batch],
                dtype=object,
            )

    return text(ids)


@own_names("text_in")
def transcode(docs: DataFrame, text_col: str, model: bytes) -> DataFrame:
    """``docs`` with ``ids`` (packed) and ``decoded``, their text, in place of the text column
    and of columns called like them. All others stay as they are.

    One worker a task does both, in small batches, so memory follows the longest texts only.
    """
    kept = docs.drop(text_col, "ids", "decoded")
    schema = T.StructType([*kept.schema, *T.StructType.fromDDL("ids binary, decoded string")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for whole in lean(batches, "codecs"):
            for start in range(0, whole.num_rows, OUT_ROWS):
                batch = whole.slice(start, OUT_ROWS)
                ids = [own.encode(x.as_py()) for x in batch.column(0)]
                back = [own.decode(struct.unpack(f"<{len(x) >> 2}I", x)) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], pa.array(ids, pa.binary()), pa.array(back, pa.string())],
                    names=schema.names,
                )

    return docs.select(F.col(text_col).alias("text_in"), *kept.columns).mapInArrow(run, schema)
