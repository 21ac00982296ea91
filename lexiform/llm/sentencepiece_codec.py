"""SentencePiece encoding and decoding that keeps source offsets.

Normalisation is done here: the longest prefix of the remaining text that the model's compiled character map knows is
replaced, and for every normalised byte the source byte it came from is recorded. White space is escaped, a dummy prefix is
put in front, and the pieces of the segmented text are projected through that alignment to spans of original UTF-8 bytes.

Segmentation: no piece of the vocabulary goes on with another character and then a space mark (checked when the model is
loaded), so the text falls into units ``marks + other characters`` that are segmented alone. A bounded memo keeps the ids of
units; new units of a batch go to the library's segmenter together. Models for which this does not hold are segmented whole.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiform.llm import scratch

SPACE = "▁"
#: Characters of texts that are segmented together.
BATCH_CHARS = 2_000_000
#: Units that each of two memos keeps at most; a full one becomes the older one, whose units come back when met again.
MEMO_UNITS = 150_000
#: Longer units are segmented without being kept.
MEMO_UNIT_CHARS = 48


class CharacterMap:
    """The compiled map of a model: a double-array trie over UTF-8 bytes whose values are offsets of replacements."""

    def __init__(self, blob: bytes):
        self.units = np.zeros(0, np.uint32)
        self.texts = b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = np.frombuffer(blob, "<u4", size // 4, 4)
            self.texts = blob[4 + size :]

    def longest_prefix(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix of ``data[at:]`` and its replacement; None without one."""
        units = self.units
        if not len(units):
            return None
        offset = lambda u: (u >> 10) << ((u & 512) >> 6)
        found, node = None, 0
        unit = int(units[0])
        node ^= offset(unit)
        for i in range(at, len(data)):
            byte = data[i]
            node ^= byte
            if node >= len(units):
                break
            unit = int(units[node])
            if unit & 0x800000FF != byte:
                break
            node ^= offset(unit)
            if unit >> 8 & 1:
                value = int(units[node]) & 0x7FFFFFFF
                end = self.texts.index(b"\0", value)
                found = (i + 1 - at, self.texts[value:end])
        return found


def _char_bytes(first: int) -> int:
    return 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


class Codec:
    """One loaded model. ``encode`` and ``decode`` give what the library gives; ``spans`` gives original byte ranges."""

    def __init__(self, model_file: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        proto = pb.ModelProto()
        with open(model_file, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.identity = not len(self.map.units)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        kinds = pb.ModelProto.SentencePiece.Type
        self.bos, self.eos, self.unk = self.library.bos_id(), self.library.eos_id(), self.library.unk_id()
        self.surface: list[bytes] = []
        self.raw: list[bool] = []
        self.silent: list[bool] = []
        for p in proto.pieces:
            byte, control = p.type == kinds.BYTE, p.type == kinds.CONTROL
            self.raw.append(byte)
            self.silent.append(control)
            self.surface.append(bytes([int(p.piece[3:5], 16)]) if byte else b"" if control else proto.trainer_spec.unk_surface.encode() if p.type == kinds.UNKNOWN else p.piece.replace(SPACE, " ").encode())
        self.normal_bytes = np.array([1 if b else 0 if c else len(p.piece.encode()) for p, b, c in zip(proto.pieces, self.raw, self.silent, strict=True)], np.int64)
        self.source_bytes = np.array([len(s) for s in self.surface], np.int64)
        self.spoken = ~np.array(self.silent)
        user = any(p.type == kinds.USER_DEFINED for p in proto.pieces)
        inner = any(SPACE in p.piece.lstrip(SPACE) for p in proto.pieces)
        #: Units are independent, and those of an identity map need no normaliser of their own.
        self.by_units = self.identity and self.prefix and self.escape and not self.squeeze and not user and not inner and proto.trainer_spec.model_type == 2 and not proto.trainer_spec.treat_whitespace_as_suffix
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised UTF-8 and, for each of its bytes and its end, the original byte offset it came from."""
        data = text.encode("utf-8", "replace")
        mark = SPACE.encode() if self.escape else b" "
        out, source, at = bytearray(), [], 0

        def prefix(i: int) -> tuple[int, bytes]:
            hit = self.map.longest_prefix(data, i)
            if hit:
                return hit
            n = _char_bytes(data[i])
            return n, data[i : i + n]

        if self.squeeze:
            while at < len(data):
                n, piece = prefix(at)
                if piece != b" ":
                    break
                at += n
        if at >= len(data):
            return b"", np.array([at], np.int64)
        if self.prefix:
            out += mark
            source += [at] * len(mark)
        space = self.squeeze
        while at < len(data):
            n, piece = prefix(at)
            if space and self.squeeze:
                piece = piece.lstrip(b" ")
            if piece:
                start = len(out)
                out += piece.replace(b" ", mark)
                # what stays as it is aligns byte by byte, so that byte pieces have spans of their own
                source += range(at, at + n) if piece == data[at : at + n] and b" " not in piece else [at] * (len(out) - start)
                space = piece.endswith(b" ")
            else:
                space = self.squeeze
            at += n
        if self.squeeze:
            while out.endswith(mark):
                at = source[len(out) - len(mark)]
                del out[-len(mark) :], source[-len(mark) :]
        return bytes(out), np.array([*source, at], np.int64)

    @staticmethod
    def _units(text: str) -> list[str]:
        """Units with their space marks as blanks. ``text`` has the dummy prefix already; blanks before a word go with it."""
        parts = text.split(" ")
        out, blanks = [], 0
        for p in parts[1:]:  # parts[0] is what stands before the prefix: nothing
            blanks += 1
            if p:
                out.append(" " * blanks + p)
                blanks = 0
        if blanks:
            out.append(" " * blanks)
        return out

    def _look_up(self, units: set[str]) -> dict[str, bytes]:
        """Ids of units that the younger memo lacks: from the older memo, else from the library, all in one call."""
        found = {u: self.older[u] for u in units if u in self.older}
        new = [u for u in units if u not in found]
        # the library puts the dummy prefix itself, except before nothing: one leading mark of each unit is left out
        for u, x in zip(new, self.library.encode([u[1:] for u in new], num_threads=1) if new else (), strict=True):
            found[u] = struct.pack(f"<{len(x)}I", *x) if x else struct.pack("<I", self.library.piece_to_id(SPACE))
        keep = {u: x for u, x in found.items() if len(u) <= MEMO_UNIT_CHARS}
        if len(self.memo) + len(keep) > MEMO_UNITS:
            self.older, self.memo = self.memo, {}
        if len(keep) <= MEMO_UNITS:
            self.memo.update(keep)
        return found

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """For each text its ids with begin and end, as little-endian unsigned 32-bit integers."""
        head, tail = struct.pack("<I", self.bos), struct.pack("<I", self.eos)
        if not self.by_units:
            return [head + np.array(ids, "<u4").tobytes() + tail for ids in self.library.encode(texts, num_threads=1)] if texts else []
        out, at = [], 0
        while at < len(texts):
            upto, chars = at, 0
            while upto < len(texts) and (upto == at or chars + len(texts[upto]) <= BATCH_CHARS):
                chars += len(texts[upto])
                upto += 1
            units = [self._units(" " + t.replace(SPACE, " ")) if t else [] for t in texts[at:upto]]
            memo = self.memo
            missing = {u for us in units for u in us if u not in memo}
            own = self._look_up(missing) if missing else {}
            for us in units:
                try:
                    ids = [memo[u] for u in us]
                except KeyError:
                    ids = [own[u] if u in own else memo[u] for u in us]
                out.append(head + b"".join(ids) + tail)
            at = upto
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_many([text])[0], "<u4").tolist()

    def spans(self, text: str, ids: np.ndarray) -> np.ndarray:
        """(begin, end) of each id in original UTF-8 bytes; control ids get an empty span where they stand.

        Pieces tile the normalised text, so their normalised ends are a running sum; the alignment projects those ends.
        The dummy prefix has no source bytes.
        """
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return np.zeros((0, 2), np.int64)
        if self.identity and not self.squeeze and SPACE not in text and not (ids == self.unk).any():
            lengths = self.source_bytes[ids].copy()
            first = int(self.spoken[ids].argmax())
            if self.prefix and self.spoken[ids[first]]:
                lengths[first] -= 1
            ends = np.cumsum(lengths)
            return np.stack([ends - lengths, ends], 1)
        _, source = self.normalise(text)
        if (ids == self.unk).any():
            raise ValueError("spans of unknown ids need a model with byte fallback")
        ends = np.cumsum(self.normal_bytes[ids])
        starts = ends - self.normal_bytes[ids]
        return np.stack([source[starts], source[ends]], 1)

    def decode(self, ids: list[int]) -> str:
        """Text of ids. Runs of byte pieces are read as UTF-8; a byte that fits nowhere becomes U+FFFD alone."""
        surface = self.surface
        parts = list(map(surface.__getitem__, ids))
        if self.prefix or self.squeeze:
            for i, k in enumerate(ids):
                if self.silent[k]:
                    continue
                if not self.raw[k] and k != self.unk and parts[i].startswith(b" "):
                    parts[i] = parts[i][1:]
                break
        data = b"".join(parts)
        try:
            return data.decode("utf-8")
        except UnicodeDecodeError:
            return self._decode_broken(ids, parts)

    def _decode_broken(self, ids: list[int], parts: list[bytes]) -> str:
        out, run = [], bytearray()

        def flush() -> None:
            at = 0
            while at < len(run):
                n = _char_bytes(run[at])
                try:
                    out.append(bytes(run[at : at + n]).decode("utf-8"))
                    at += n
                except UnicodeDecodeError:
                    out.append("�")
                    at += 1
            run.clear()

        for k, p in zip(ids, parts, strict=True):
            if self.raw[k]:
                run += p
            else:
                flush()
                out.append(p.decode("utf-8"))
        flush()
        return "".join(out)


_LOADED: dict[str, Codec] = {}


def codec(model_file: str) -> Codec:
    if model_file not in _LOADED:
        _LOADED[model_file] = Codec(model_file)
    return _LOADED[model_file]


def encode_documents(docs: DataFrame, model_file: str, text: str = "text", with_spans: bool = True) -> DataFrame:
    """Columns of ``docs`` plus ``token_ids`` (array of int), ``decoded`` and, if asked, ``span_start``/``span_end``.

    Null texts count as empty: the ids are begin and end alone, the decoded text is empty. Result columns replace columns of
    ``docs`` with the same names. No shuffle; each batch is bounded by Spark's Arrow batch size.
    """
    scratch.ship(docs.sparkSession)
    added = ["token_ids array<int>", "decoded string"] + (["span_start array<int>", "span_end array<int>"] if with_spans else [])
    names = [a.split()[0] for a in added]
    kept = docs.drop(*names)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_file)
        for b in scratch.slices(batches, text):
            texts = [t or "" for t in b.column(b.schema.get_field_index(text)).to_pylist()]
            ids = [np.frombuffer(x, "<u4") for x in c.encode_many(texts)]
            cols = [pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array([c.decode(x.tolist()) for x in ids], pa.string())]
            if with_spans:
                spans = [c.spans(t, x) for t, x in zip(texts, ids, strict=True)]
                cols += [pa.array([s[:, 0].astype(np.int32) for s in spans], pa.list_(pa.int32())), pa.array([s[:, 1].astype(np.int32) for s in spans], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, *names])

    return kept.mapInArrow(run, schema)


def digest_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes, spans_sha256 and whether the spans tile the whole text.

    The same encoding as :func:`encode_documents`, with each document's ids, text and spans reduced to digests.
    """
    scratch.ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_file)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in scratch.slices(batches, 1):
            texts = [t or "" for t in b.column(1).to_pylist()]
            rows = []
            for t, raw in zip(texts, c.encode_many(texts), strict=True):
                ids = np.frombuffer(raw, "<u4")
                spans = c.spans(t, ids)
                n = len(t.encode("utf-8", "replace"))
                tiled = bool(spans[0, 0] == 0 and spans[-1, 1] == n and (spans[1:, 0] == spans[:-1, 1]).all())
                rows.append((len(ids), sha(raw), sha(c.decode(ids.tolist()).encode("utf-8")), n, sha(spans.astype("<u4").tobytes()), tiled))
            cols = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True) if rows else [()] * 6, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "spans_sha256", "spans_tile"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long, spans_sha256 string, spans_tile boolean")
