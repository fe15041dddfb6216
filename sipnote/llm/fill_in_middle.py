"""Fill-in-the-middle transformation of whole documents, assembled by a secondary sort.

A text is units: runs of letters A-Z, and every other code point alone. Two cuts from a digest of the
document's id divide the units into prefix, middle and suffix. Each section leaves its row as pieces of
at most ``UNITS`` units, keyed by document and by their position in the output. One shuffle by document,
sorted by position inside each partition, streams the pieces into incremental digests, so no task holds
an output. There the output stream is cut again at its marks, by nothing but the stream and the form;
what comes out is sorted anew inside the partition, by its place in the text, and digested. The second
sort needs no second shuffle.

Equal rows (id and text) are told apart by nothing, so each task sends their pieces once and counts
them; a hot row costs a task as much as any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sipnote.llm.common import settings, whole
from sipnote.session import written

UNITS = 4096
SEED = 1
# Of a hundred documents, those from here on stay plain; of a hundred others, those below have the suffix first.
PLAIN_FROM, SUFFIX_FIRST_BELOW = 90, 20
# Documents a task remembers; then it sends their counts and begins anew.
REMEMBERED = 20_000
# Equal rows given out as one, to be repeated later.
REPEATED = 10_000
BATCH_BYTES = 4 * 1024 * 1024

# Sections in the order of their marks in the output.
FORMS = {"psm": ("P", "S", "M"), "spm": ("S", "P", "M")}
# Places of the sections in the text.
PLACES = {"P": 0, "M": 1, "S": 2}
MARKS = {k: f"<{k}>".encode() for k in PLACES}

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True

PIECES = (
    "key binary, position int, data binary, doc_id long, n long, form string, "
    "prefix_chars long, middle_chars long, copies long"
)
RESTORED = (
    "key binary, place int, number int, data binary, doc_id long, n long, form string, "
    "prefix_chars long, middle_chars long, copies long, output_sha256 string, output binary"
)
RESULT = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, copies long, "
    "output_sha256 string, restored_sha256 string, output binary"
)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"binary": pa.binary(), "string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


class Units:
    """Where the units and the code points of some UTF-8 texts begin."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.begins = self.ends - np.array([len(t) for t in texts], np.int64)
        letter = _LETTER[raw]
        inside = np.zeros(len(raw), bool)
        inside[1:] = letter[1:] & letter[:-1]
        # A text is not joined to the one before.
        inside[self.begins[self.begins < len(raw)]] = False
        first = (raw & 0xC0) != 0x80
        self.chars = np.flatnonzero(first)
        self.units = np.flatnonzero(first & ~inside)
        self.first = np.searchsorted(self.units, self.begins)
        self.count = np.searchsorted(self.units, self.ends) - self.first

    def byte(self, text: int, unit: int) -> int:
        """The byte of a text at which one of its units begins, or its end."""
        if unit >= self.count[text]:
            return int(self.ends[text] - self.begins[text])
        return int(self.units[self.first[text] + unit] - self.begins[text])

    def chars_between(self, text: int, start: int, end: int) -> int:
        a, b = np.searchsorted(self.chars, [self.begins[text] + start, self.begins[text] + end])
        return int(b - a)


def chosen_form(text: bytes, h3: int, h4: int) -> str:
    if not text or h3 % 100 >= PLAIN_FROM or any(m in text for m in MARKS.values()):
        return "plain"
    return "spm" if h4 % 100 < SUFFIX_FIRST_BELOW else "psm"


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, h1, h2, h3, h4) to ``PIECES``: a row at position -1 about the document, then its output."""
    about: dict[bytes, list] = {}

    def heads() -> pa.RecordBatch:
        rows = [(k, -1, None, *a) for k, a in about.items()]
        about.clear()
        return _batch(rows, PIECES)

    for batch in batches:
        ids = batch.column(0).to_pylist()
        texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
        numbers = zip(*(batch.column(i).to_pylist() for i in range(2, 6)))
        units = Units(texts)
        out: list[tuple] = []
        for i, (doc_id, text, (h1, h2, h3, h4)) in enumerate(zip(ids, texts, numbers)):
            key = hashlib.blake2b(f"{doc_id}:".encode() + text, digest_size=16).digest()
            if key in about:
                about[key][-1] += 1
                continue
            n = int(units.count[i])
            low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
            form = chosen_form(text, h3, h4)
            if form == "plain":
                sections = [(b"", 0, n)]
                chars = (None, None)
            else:
                at = {"P": (0, low), "M": (low, high), "S": (high, n)}
                sections = [(MARKS[k], *at[k]) for k in FORMS[form]]
                a, b = units.byte(i, low), units.byte(i, high)
                chars = (units.chars_between(i, 0, a), units.chars_between(i, a, b))
            about[key] = [doc_id, n, form, *chars, 1]
            position = 0
            for mark, start, end in sections:
                for at_unit in range(start, max(end, start + 1), UNITS):
                    a, b = units.byte(i, at_unit), units.byte(i, min(at_unit + UNITS, end))
                    out.append((key, position, mark + text[a:b], *[None] * 6))
                    mark = b""
                    position += 1
        yield _batch(out, PIECES)
        if len(about) >= REMEMBERED:
            yield heads()
    yield heads()


class Sections:
    """Cuts an output, given bit by bit, at its marks."""

    def __init__(self, form: str):
        self.marks = list(FORMS.get(form, ()))
        self.place = 0
        self.rest = b""

    def feed(self, data: bytes) -> Iterator[tuple[int, bytes]]:
        """(place in the text, bytes); up to two bytes are kept back, as a mark may begin with them."""
        data = self.rest + data
        while self.marks:
            at = data.find(MARKS[self.marks[0]])
            if at < 0:
                keep = max(0, len(data) - 2)
                yield self.place, data[:keep]
                self.rest = data[keep:]
                return
            yield self.place, data[:at]
            self.place = PLACES[self.marks.pop(0)]
            data = data[at + 3 :]
        self.rest = b""
        yield self.place, data

    def end(self) -> tuple[int, bytes]:
        return self.place, self.rest


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


class Assembler:
    """Streams sorted pieces into outputs: their digests, and their bytes cut at the marks."""

    def __init__(self, texts: bool):
        self.texts = texts

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = 0
        for row in self._rows(_runs(batches)):
            out.append(row)
            held += len(row[3] or b"") + len(row[-1] or b"")
            if held >= BATCH_BYTES or len(out) >= 5000:
                yield _batch(out, RESTORED)
                out, held = [], 0
        yield _batch(out, RESTORED)

    def _rows(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        key = about = None
        for k, position, data, *facts in rows:
            if k != key:
                if key is not None:
                    yield from self._end(key, about, digest, sections, number, copies, kept)
                key, about, copies, last = k, facts[:-1], 0, -1
                digest, sections, number, kept = hashlib.sha256(), Sections(about[2]), 0, []
            if position < 0:
                copies += facts[-1]
            elif position != last:  # pieces of equal rows come from several tasks
                last = position
                digest.update(data)
                if self.texts:
                    kept.append(data)
                for place, part in sections.feed(data):
                    if part:
                        yield (key, place, number, part, *[None] * 8)
                        number += 1
        if key is not None:
            yield from self._end(key, about, digest, sections, number, copies, kept)

    def _end(self, key, about, digest, sections, number, copies, kept) -> Iterator[tuple]:
        place, part = sections.end()
        if part:
            yield (key, place, number, part, *[None] * 8)
        output = b"".join(kept) if self.texts else None
        yield (key, -1, 0, None, *about, copies, digest.hexdigest(), output)


def restorer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams sorted ``RESTORED`` rows into digests of the texts they give back."""
    out: list[tuple] = []
    about = digest = None

    def end() -> None:
        *facts, copies, output_sha256, output = about
        for start in range(0, copies, REPEATED):
            out.append((*facts, min(REPEATED, copies - start), output_sha256, digest.hexdigest(), output))

    for _, place, _, data, *facts in _runs(batches):
        if place < 0:
            if about is not None:
                end()
            about, digest = facts, hashlib.sha256()
        else:
            digest.update(data)
        if len(out) >= 2000:
            yield _batch(out, RESULT)
            out.clear()
    if about is not None:
        end()
    yield _batch(out, RESULT)


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, texts: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256``, and with ``texts`` the whole ``output``.

    ``n`` counts the units of the text. Form is ``plain``, ``psm`` (prefix, suffix, middle) or ``spm``
    (suffix, prefix, middle); the numbers of code points are null where it is plain. A null text is
    empty, and empty is plain; so is a text that holds a mark. A null id counts as no digits in the
    digest that places the cuts. Rows with equal ids are documents each, equal rows too. An empty
    table gives an empty result; other columns are ignored, whatever their names.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    number = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text")).select("doc_id", "text", *number)
    limits = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
    }
    with settings(docs.sparkSession, limits):
        sent = rows.mapInArrow(pieces, PIECES).repartition(F.col("key")).sortWithinPartitions("key", "position")
        placed = sent.mapInArrow(Assembler(texts).run, RESTORED).sortWithinPartitions("key", "place", "number")
        out = written(placed.mapInArrow(restorer, RESULT), "fill-in-middle")
    each = out.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    return each.select(*columns, *([F.col("output").cast("string").alias("output")] if texts else []))
