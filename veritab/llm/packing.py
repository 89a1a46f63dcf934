"""Concatenate and cut: documents' tokens in one line, cut into windows of equal length."""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.common import release, releasing, stored

SEQUENCE = 2048
END = 1
VOCABULARY = "word_bpe_49k.json"
#: Pieces of words that a task remembers before it starts anew; bytes of text, and words of it, that it works on at a time.
REMEMBERED, SLICE, STEP = 200_000, 4 << 20, 1 << 16

#: Fixed value: how the tokenizer cuts a word, as in its file.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Words of other characters, or with a bracket, go through the whole tokenizer.
PLAIN = regex.compile(r"[\x21-\x3B\x3D\x3F-\x7E\u00C0-\u024F]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as a letter: visible bytes of Latin-1 as they are, others from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in seen)}


class WordTokens:
    """Ids of texts by a tokenizer that drops white space, and so works on each word by itself.

    A text's ids are those of its words put together, and a word's those of its pieces. Each different word is looked at
    once a call, and pieces are remembered. Ids are kept as bytes, and words as they lie in the column: as objects they
    would take many times the text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.letters, self.pieces = Tokenizer.from_file(path), _byte_letters(), {}

    def _piece(self, piece: str) -> bytes:
        if (ids := self.pieces.get(piece)) is None:
            if len(self.pieces) >= REMEMBERED:
                self.pieces.clear()
            spelt = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
            ids = self.pieces[piece] = array("I", [t.id for t in self.tokenizer.model.tokenize(spelt)]).tobytes()
        return ids

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if word.isascii():
            text = text.lower()
            if text.isalpha():
                return self._piece(text)
            stem = text.rstrip(".,;:!?")
            if stem.isalpha():
                return self._piece(stem) + self._piece(text[len(stem) :])
        if not PLAIN.fullmatch(text):
            return array("I", self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()
        text = unicodedata.normalize("NFC", text).lower()
        if text.isalpha():
            return self._piece(text)
        return b"".join(map(self._piece, PIECES.findall(text)))

    def encode(self, texts: pa.Array | list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has. Null counts as empty."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary()).view(pa.string())
        words = pc.ascii_split_whitespace(column)
        per_text = pc.list_value_length(words).fill_null(0).to_numpy(zero_copy_only=False)
        coded = words.flatten().dictionary_encode()
        which, words = coded.indices.to_numpy(), coded.dictionary
        lengths, parts = np.zeros(len(words), np.int32), []
        for low in range(0, len(words), STEP):
            some = words.slice(low, STEP)
            raws = [self._word(w) for w in some.view(pa.binary() if some.type == pa.string() else pa.large_binary()).to_pylist()]
            lengths[low : low + STEP] = np.fromiter(map(len, raws), np.int32, len(raws)) // 4
            parts.append(_narrow(np.frombuffer(b"".join(raws), np.uint32)))
        known = np.concatenate(parts) if parts else np.zeros(0, np.uint16)
        starts, total = np.cumsum(lengths, dtype=np.int64) - lengths, np.zeros(len(which) + 1, np.int64)
        np.cumsum(lengths[which], out=total[1:])
        ids = np.empty(total[-1], known.dtype)
        for low in range(0, len(which), STEP):
            some, ends = which[low : low + STEP], total[low + 1 : low + STEP + 1]
            first = int(total[low])
            place = np.arange(first, int(ends[-1])) + np.repeat(starts[some] + lengths[some] - ends, lengths[some])
            ids[first : int(ends[-1])] = known[place]
        words_end = np.cumsum(per_text)
        return ids, total[words_end] - total[words_end - per_text]


def _narrow(ids: np.ndarray) -> np.ndarray:
    """Ids in two bytes each where they fit."""
    return ids if len(ids) and ids.max() > 65535 else ids.astype(np.uint16)


def _tokens(text: str, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, words = TaskContext.get().partitionId(), 0, WordTokens(path)
        for batch in _sliced(batches, text, SLICE):
            ids, counts = words.encode(batch.column(batch.schema.get_field_index(text)))
            pieces = np.split(ids, np.cumsum(counts)[:-1])
            n = counts + 1
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            rest = batch.drop_columns([text])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part), pa.int32()), pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array([p.itemsize for p in pieces], pa.int32()), pa.array([p.tobytes() for p in pieces], pa.binary()), *rest.columns],
                names=["part", "start_in_part", "doc_tokens", "width", "ids", *rest.schema.names],
            )

    return run


def _slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes each; a longer row ends one."""
    low = size = 0
    for i, n in enumerate(sizes.tolist()):
        size += n
        if size > most:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(sizes):
        yield low, len(sizes)


def _sliced(batches: Iterator[pa.RecordBatch], name: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``most`` bytes of a column each; a longer row ends one, and null has none."""
    for batch in batches:
        for low, high in _slices(pc.binary_length(batch.column(batch.schema.get_field_index(name))).fill_null(0).to_numpy(zero_copy_only=False), most):
            yield batch.slice(low, high - low)
            release()


def _pieces(sequence: int, end: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches, "ids", SLICE // 4):
            rest = batch.drop_columns(["first", "doc_tokens", "width", "ids"])
            columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("first", "doc_tokens", "width")]
            rows, starts, lengths, crcs, raws = [], [], [], [], []
            for i, (first, n, width, raw) in enumerate(zip(*columns, batch.column("ids").to_pylist(), strict=True)):
                ids = np.append(np.frombuffer(raw, f"<u{width}").astype("<u4"), np.uint32(end)).astype("<u4")
                start = 0
                while start < n:
                    length = int(min(n - start, sequence - (first + start) % sequence))
                    data = ids[start : start + length].tobytes()
                    rows.append(i), starts.append(start), lengths.append(length), crcs.append(zlib.crc32(data))
                    if with_ids:
                        raws.append(data)
                    start += length
            rows = np.asarray(rows, np.int64)
            starts, at = np.asarray(starts, np.int64), columns[0][rows] + np.asarray(starts, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(starts), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()), pa.array(columns[1][rows], pa.int64()), pa.array(at // sequence, pa.int64()), pa.array(at % sequence, pa.int64()), *([pa.array(raws, pa.binary())] if with_ids else []), *rest.take(pa.array(rows)).columns],
                names=["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else []), *rest.schema.names],
            )

    return run


def pack(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", sequence: int = SEQUENCE, end: int = END, with_ids: bool = True) -> DataFrame:
    """Pieces of documents in sequences of ``sequence`` tokens.

    Columns: the id, start (tokens of its document before it), length, ids_crc32, doc_tokens, sequence_id, offset, and
    with ``with_ids`` the ids as little-endian 32-bit integers.

    A first pass tokenizes each document once, adds the end id, and stores the ids with the document's place in its
    partition. Prefix sums over the partitions' totals, one row each, then give its place in the whole line, and a
    second pass cuts it at the multiples of ``sequence``: a document that lies across a border becomes several pieces.
    All sequences are full but the last. The stored table fixes the order, so a retry of a task cuts the same way.

    Null texts count as empty and consist of the end id. Ids may be null or repeat: each row is packed by itself.
    Texts may be of any length. An empty table gives no pieces. Further columns are ignored.
    """
    narrow = docs.select(F.col(id_column).alias("id_value"), F.col(text_column).cast("string").alias("text_value"))
    kind = narrow.schema["id_value"].dataType.simpleString()
    tokens = stored(
        narrow.mapInArrow(releasing(_tokens("text_value", tokenizer_path)), f"part int, start_in_part long, doc_tokens long, width int, ids binary, id_value {kind}"), "tokens"
    )
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = stored(totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before")), "places")
    line = tokens.join(places, "part").select("id_value", (F.col("before") + F.col("start_in_part")).alias("first"), "doc_tokens", "width", "ids")
    out = line.mapInArrow(
        releasing(_pieces(sequence, end, with_ids)),
        f"start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, {'ids binary, ' if with_ids else ''}id_value {kind}",
    )
    return out.select(F.col("id_value").alias(id_column), *[c for c in out.columns if c != "id_value"])
