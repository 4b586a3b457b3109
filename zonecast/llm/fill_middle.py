"""Fill-in-middle transformation by secondary-sort assembly (operator 13).

A text is cut after two code points drawn from its id into prefix, middle and
suffix, and written with marks as ``<P>prefix<S>suffix<M>middle`` (psm) or
``<S>suffix<P>prefix<M>middle`` (spm); some stay plain. Nothing is assembled where
the text is read: it leaves as chunks of at most ``UNIT`` code points keyed by
document and place in the output. One shuffle by document with a sort by (document,
place) brings them together, and a task streams them into an incremental digest. The
same pass reads the marks out of the stream, names what lies between them by its
place in the text, and a second sort inside the partition streams the restoration.
A task holds a chunk, not a document. Chunks are deflated for the shuffle.

``outputs`` gives the texts themselves, ``restored`` turns them back, ``digests``
gives the hashes of both.

Defined results: null counts as empty; an empty text and one that holds a mark are
plain; a null id draws as the text ``null``; rows with one id, and equal rows, stay
rows of their own; a text of one code point or more has cuts at 0..n, so any part may
be empty; an empty table gives an empty result; other columns are not read. Rows are
told apart by the place at which they are read, so ``docs`` should be read from
files or a written table (as for ``monotonically_increasing_id``).
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.arrow import map_batches

#: Code points of a chunk.
UNIT = 1 << 16
#: Bytes of an Arrow batch that a task hands on.
BATCH = 1 << 22
MARKS = ("<P>", "<S>", "<M>")
_MARK = re.compile(rb"<[PSM]>")
#: Parts in output order, by form, with their place in the text.
LAYOUT = {"plain": (("", 0),), "psm": (("<P>", 0), ("<S>", 2), ("<M>", 1)), "spm": (("<S>", 2), ("<P>", 0), ("<M>", 1))}
_PLACE = {b"<P>": 0, b"<M>": 1, b"<S>": 2}
_END = 3  # place of a document's facts, after its parts


class Rows:
    """Collects rows and hands them on in batches of bounded bytes."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size + 64
        if self.size > BATCH:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*self.rows, strict=True), self.schema, strict=True)], schema=self.schema)
        self.rows, self.size = [], 0


def draw(salt: str, key, text: str, plain: int, spm: int) -> tuple[str, int, int]:
    """(form, end of the prefix, end of the middle) of one document."""
    h = hashlib.sha256(f"{salt}:{'null' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or h3 % 100 >= 100 - plain or any(m in text for m in MARKS):
        return "plain", n, n
    return ("spm" if h4 % 100 < spm else "psm"), a, b


def chunks(docs: DataFrame, salt: str = "1", plain: int = 10, spm: int = 20, id_col: str = "doc_id",
           text_col: str = "text", unit: int = UNIT) -> DataFrame:
    """(row, pos, body, id, n, form, cut, until): the output of every row in chunks.
    ``pos`` is a chunk's place in the output; the columns after ``body`` are filled at
    place 0. ``plain`` and ``spm`` are percentages."""
    kind = docs.schema[id_col].dataType
    schema = pa.schema([("row", pa.int64()), ("pos", pa.int64()), ("body", pa.binary()), ("id", pa.string()),
                        ("n", pa.int64()), ("form", pa.string()), ("cut", pa.int64()), ("until", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for batch in batches:
            for row, key, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                row, key, text = row.as_py(), key.as_py(), text.as_py() or ""
                form, a, b = draw(salt, key, text, plain, spm)
                span = {0: (0, a), 1: (a, b), 2: (b, len(text))}
                facts, pos = (key, len(text), form, a, b), 0
                for mark, place in LAYOUT[form]:
                    lo, end = span[place]
                    while True:
                        body = (mark + text[lo:min(lo + unit, end)]).encode()
                        yield from out.add((row, pos, zlib.compress(body, 1), *(facts if not pos else [None] * 5)), len(body))
                        lo, mark, pos = lo + unit, "", pos + 1
                        if lo >= end:
                            break
        yield from out.rest()

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("string").alias("id"),
                       F.col(text_col).alias("text"))
    found = map_batches(rows, work, "row long, pos long, body binary, id string, n long, form string, cut long, until long")
    return found.withColumn("id", F.col("id").cast(kind))


def ordered(pieces: DataFrame) -> DataFrame:
    """The chunks of a document beside each other, in output order: the shuffle."""
    return pieces.repartition("row").sortWithinPartitions("row", "pos")


def outputs(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row."""
    pieces = chunks(docs, id_col=id_col, **options)
    kind = pieces.schema["id"].dataType
    schema = pa.schema([("id", pa.string()), ("n", pa.int64()), ("form", pa.string()), ("cut", pa.int64()),
                        ("until", pa.int64()), ("output", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, facts, last = Rows(schema), [], None, None
        for batch in batches:
            for row, body, *own in zip(*(batch.column(c).to_pylist() for c in ("row", "body", *schema.names[:-1])), strict=True):
                if row != last and facts:
                    yield from out.add((*facts, b"".join(held).decode()), sum(map(len, held)))
                if row != last:
                    last, held, facts = row, [], own
                held.append(zlib.decompress(body))
        if facts:
            yield from out.add((*facts, b"".join(held).decode()), 0)
        yield from out.rest()

    ready = ordered(pieces.withColumn("id", F.col("id").cast("string")))
    found = map_batches(ready, work, "id string, n long, form string, cut long, until long, output string")
    return _facts(found, kind, id_col, "output")


def restored(made: DataFrame, form_col: str = "form", output_col: str = "output", text_col: str = "text") -> DataFrame:
    """``made`` with the text that each output stands for."""
    part = F.split(F.col(output_col), "<[PSM]>", -1)
    psm, spm = (F.concat(*[F.element_at(part, i) for i in order]) for order in ((2, 4, 3), (3, 4, 2)))
    return made.withColumn(text_col, F.when(F.col(form_col) == "psm", psm).when(F.col(form_col) == "spm", spm)
                           .otherwise(F.col(output_col)))


class Reader:
    """Reads a document's output as it streams by and gives (place, bytes) of the text."""

    def __init__(self, form: str):
        self.place, self.held = (0 if form == "plain" else None), b""
        self.marked = form != "plain"

    def feed(self, body: bytes) -> Iterator[tuple[int, bytes]]:
        if not self.marked:
            yield 0, body
            return
        body, at = self.held + body, 0
        for m in _MARK.finditer(body):
            if m.start() > at:
                yield self.place, body[at:m.start()]
            at, self.place = m.end(), _PLACE[m.group()]
        # a mark may be cut by the end of the chunk
        keep = 2 if body[max(at, len(body) - 2):] in (b"<P", b"<S", b"<M") else int(body.endswith(b"<") and len(body) > at)
        self.held = body[len(body) - keep:]
        if len(body) - keep > at:
            yield self.place, body[at:len(body) - keep]

    def rest(self) -> Iterator[tuple[int, bytes]]:
        if self.held:
            yield self.place, self.held


def digests(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of
    every row; the second digest is that of the text rebuilt from output and form."""
    pieces = chunks(docs, id_col=id_col, **options)
    kind = pieces.schema["id"].dataType
    facts = ("id", "n", "form", "cut", "until")
    first = pa.schema([("row", pa.int64()), ("place", pa.int64()), ("pos", pa.int64()), ("body", pa.binary()),
                       ("id", pa.string()), ("n", pa.int64()), ("form", pa.string()), ("cut", pa.int64()),
                       ("until", pa.int64()), ("output_sha256", pa.string())])
    last_schema = pa.schema([*(first.field(c) for c in (*facts, "output_sha256")), ("restored_sha256", pa.string())])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Output order in; its digest and the parts, named by their place in the text, out."""
        out, last, own, digest, reader, seq = Rows(first), None, None, None, None, 0

        def part(place, body):
            nonlocal seq
            seq += 1
            return out.add((last, place, seq, body, None, None, None, None, None, None), len(body))

        def done():
            for place, body in reader.rest():
                yield from part(place, body)
            yield from out.add((last, _END, 0, None, *own, digest.hexdigest()), 64)

        for batch in batches:
            for row, body, *mine in zip(*(batch.column(c).to_pylist() for c in ("row", "body", *facts)), strict=True):
                if row != last:
                    if last is not None:
                        yield from done()
                    last, own, digest, reader, seq = row, mine, hashlib.sha256(), Reader(mine[2]), 0
                body = zlib.decompress(body)
                digest.update(body)
                for place, some in reader.feed(body):
                    yield from part(place, some)
        if last is not None:
            yield from done()
        yield from out.rest()

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Text order in, digests out."""
        out, digest = Rows(last_schema), hashlib.sha256()
        for batch in batches:
            for place, body, *own in zip(*(batch.column(c).to_pylist() for c in ("place", "body", *facts, "output_sha256")), strict=True):
                if place == _END:
                    yield from out.add((*own, digest.hexdigest()), 192)
                    digest = hashlib.sha256()
                else:
                    digest.update(body)
        yield from out.rest()

    names = "id string, n long, form string, cut long, until long, output_sha256 string"
    ready = ordered(pieces.withColumn("id", F.col("id").cast("string")))
    made = map_batches(ready, assemble, f"row long, place long, pos long, body binary, {names}")
    back = map_batches(made.sortWithinPartitions("row", "place", "pos"), restore, f"{names}, restored_sha256 string")
    return _facts(back, kind, id_col, "output_sha256", "restored_sha256")


def _facts(made: DataFrame, kind, id_col: str, *more: str) -> DataFrame:
    cut = F.col("form") != "plain"
    return made.select(F.col("id").cast(kind).alias(id_col), "n", "form", F.when(cut, F.col("cut")).alias("prefix_chars"),
                       F.when(cut, F.col("until") - F.col("cut")).alias("middle_chars"), *more)
