"""Token counts by a separator scan.

A flat token file is a run of fixed-width ids without any index; every document
ends with the end-of-document id. Spark reads a file of any size in byte
ranges, cut without regard to documents or ids. Each range is searched with
one vectorised comparison per alignment, as its own offset is not known yet;
a prefix scan over the ranges' few numbers then tells the alignment, joins the id
that lies over a border, and the document that runs over any number of
ranges, to their pieces.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retention.llm.batches import text_slices, utf8
from retention.llm.common import Scratch, running_totals

# fixed value: the white space of the pre-tokenization pattern
_BLANK = r"[\t-\r \x85\xa0  -     　]"


class Ranks:
    """A rank vocabulary. A white-space run that the pattern would not survive is cut out first, as the pattern would cut it."""

    def __init__(self, data: bytes, pattern: str, longest: int = 50_000):
        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        self.words = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.whole = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=table, special_tokens={})
        self.run = re.compile(f"{_BLANK}{{{longest},}}")

    def encode(self, text: str) -> list[int]:
        out, at = [], 0
        for m in self.run.finditer(text):
            # before a word the run's last character stays with the word
            end = m.end() - (m.end() < len(text))
            out += self.words.encode_ordinary(text[at:m.start()]) + self.whole.encode_ordinary(text[m.start():end])
            at = end
        return out + self.words.encode_ordinary(text[at:]) if at else self.words.encode_ordinary(text)


def write_token_files(docs: DataFrame, path: str, ranks_path: str, pattern: str, eod: int, dtype: str = "<u2",
                      text: str = "text", key: str = "doc_id") -> None:
    """Encodes every whole text: flat files ``path/kind=tokens``, and ``path/kind=ids`` with each file's document ids in order.

    A file's document is its ids and the end-of-document id, which is the
    text sink's line separator here; the sink writes bytes as they are. The two
    kinds are written side by side, so rows keep their order and a kind's file
    has the number of the other's. A null text counts as empty.
    """
    spark = docs.sparkSession
    with open(ranks_path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())   # the vocabulary file, of fixed size

    def write(batches):
        coder, written = Ranks(ranks.value, pattern), 0
        for b in text_slices(batches, "text"):
            rows = [np.array(coder.encode(t.decode()), dtype=dtype).tobytes() for t in utf8(b.column("text"))]
            ids = ",".join("" if i is None else str(i) for i in b.column("doc_id").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([f"{written}:{ids}".encode(), *rows], pa.binary()), pa.array(["ids"] + ["tokens"] * len(rows))],
                                             names=["value", "kind"])
            written += len(rows)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(write, "value binary, kind string")
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    kept = spark.conf.get(writers, None)
    spark.conf.set(writers, "4")    # else rows are sorted by kind before they are written
    try:
        rows.select(F.col("value").cast("string").alias("value"), "kind").write.partitionBy("kind").option(
            "lineSep", _mark(eod, dtype)).option("encoding", "ISO-8859-1").text(path)
    finally:
        spark.conf.unset(writers) if kept is None else spark.conf.set(writers, kept)


def _mark(eod: int, dtype: str) -> str:
    return np.array([eod], dtype=dtype).tobytes().decode("ISO-8859-1")


_BOM = b"\xef\xbb\xbf"


def _ends(data: bytes, eod: int, dtype: str) -> list[list[int]]:
    """For each number of leading bytes that belong to an id before: which of the whole ids after them are the separator."""
    width = np.dtype(dtype).itemsize
    return [np.flatnonzero(np.frombuffer(data, dtype=dtype, count=max(0, (len(data) - a) // width), offset=min(a, len(data))) == eod).tolist()
            for a in range(width)]


def scan_ranges(spark: SparkSession, path: str, eod: int, scratch: Scratch, dtype: str = "<u2") -> DataFrame:
    """A row per byte range of every file under ``path``, stored: ``file, block, file_size, bytes, head, tail, ends``.

    Ranges come from Spark's text reader, whose lines end at a byte of the
    separator; their bytes are put together again, the line ends with them.
    ``ends`` has, per alignment, the numbers of the whole ids that are separators.
    """
    width = np.dtype(dtype).itemsize
    byte = max(np.array([eod], dtype=dtype).tobytes())      # each document has one at its end
    lines = spark.read.option("lineSep", chr(byte)).option("encoding", "ISO-8859-1").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"), F.col("value").cast("binary").alias("line"))
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("file_size", pa.int64()), ("bytes", pa.int64()),
                        ("head", pa.binary()), ("tail", pa.binary()), ("ends", pa.list_(pa.list_(pa.int64())))])

    def scan(batches):
        """Ranges of a file come one after another, a range's lines in order; a range is searched piece by piece."""
        now, mark = None, bytes([byte])
        for b in batches:
            key = list(zip(b.column("file").to_pylist(), b.column("block").to_pylist()))
            cuts = [0, *(i for i in range(1, len(key)) if key[i] != key[i - 1]), len(key)]
            for i, j in zip(cuts, cuts[1:]):
                if j == i:
                    continue
                if now is None or key[i] != now["key"]:
                    if now:
                        yield close(now)
                    now = {"key": key[i], "size": b.column("file_size")[i].as_py(), "n": 0, "head": b"", "rest": b"",
                           "ends": [[] for _ in range(width)]}
                data = mark.join(b.column("line").slice(i, j - i).to_pylist()) + mark
                add(now, data)
        if now:
            yield close(now)

    def add(now, data):
        now["head"] += data[:width - 1 - len(now["head"])]
        kept = now["rest"]      # the last bytes of what was searched, fewer than an id
        base = now["n"] - len(kept)
        for a, found in enumerate(_ends(kept + data, eod, dtype)):
            # what begins a bytes into the piece is id number (base + a - alignment) / width of that alignment
            q = (base + a) % width
            now["ends"][q] += [(base + a - q) // width + x for x in found]
        now["n"] += len(data)
        now["rest"] = (kept + data)[-(width - 1):]

    def close(now):
        return pa.RecordBatch.from_pylist([{"file": now["key"][0], "block": now["key"][1], "file_size": now["size"], "bytes": now["n"],
                                            "head": now["head"], "tail": now["rest"], "ends": now["ends"]}], schema)

    return scratch.store(lines.mapInArrow(
        scan, "file string, block long, file_size long, bytes long, head binary, tail binary, ends array<array<long>>"), "ranges")


def count_tokens(spark: SparkSession, path: str, eod: int, scratch: Scratch, dtype: str = "<u2") -> DataFrame:
    """(``file``, ``ordinal``, ``start``, ``n_tokens``) of every document in the flat token files under ``path``.

    ``start`` is the document's first token in its file. An empty document
    counts 0; tokens after the last separator are a document of their own;
    an empty file has none. A file that isn't a whole number of ids raises.
    """
    width = np.dtype(dtype).itemsize
    ranges = scan_ranges(spark, path, eod, scratch, dtype)
    # a reader of text drops what looks like a byte order mark: such a file lacks three bytes, which are known
    sums = ranges.groupBy("file").agg(F.sum("bytes").alias("n"), F.first("file_size").alias("file_size"))      # a row per file
    lost = sums.where(F.col("n") < F.col("file_size")).select(
        "file", F.lit(-1).cast("long").alias("block"), "file_size", F.lit(3).cast("long").alias("bytes"), F.lit(_BOM[:width - 1]).alias("head"),
        F.lit(_BOM[1 - width:]).alias("tail"),
        F.from_json(F.lit(str(_ends(_BOM, eod, dtype))), "array<array<long>>").alias("ends"))
    placed = scratch.store(running_totals(ranges.unionByName(lost), ["block"], {"bytes": "offset"}, scratch, "ranged", by=["file"]), "placed")
    # how many bytes at a range's begin belong to an id that began before, and the bytes of that id
    over = F.pmod(-F.col("offset"), F.lit(width)).cast("int")
    order = Window.partitionBy("file").orderBy("block")     # a row per range
    before = F.concat(*[F.coalesce(F.lag("tail", k).over(order), F.lit(b"")) for k in range(width - 1, 0, -1)])
    rows = placed.select("file", "block", "bytes", "file_size", "head", "ends", over.alias("over"), before.alias("before"))
    ids = F.concat(F.expr(f"right(before, {width} - over)"), F.expr("left(head, over)"))
    joins = (F.col("over") > 0) & (F.col("bytes") >= F.col("over"))
    mark = np.array([eod], dtype=dtype).tobytes()
    first = F.when(joins & (ids == F.lit(mark)), F.array(F.lit(0).cast("long"))).otherwise(F.array().cast("array<long>"))
    own = F.transform(F.element_at("ends", F.col("over") + 1), lambda e: e + joins.cast("long"))
    n = joins.cast("long") + F.greatest(F.lit(0), F.floor((F.col("bytes") - F.col("over")) / width))
    whole = F.when(F.col("file_size") % width == 0, n).otherwise(F.raise_error(F.lit("a token file ends within an id")))
    found = scratch.store(rows.select("file", "block", whole.cast("long").alias("n"), F.concat(first, own).alias("ends"))
                          .withColumn("seps", F.size("ends").cast("long")), "found")
    # prefix scan: ids and separators before each range, in ranges, so that a file of any length is many tasks' work
    at = scratch.store(running_totals(found, ["block"], {"n": "base", "seps": "before"}, scratch, "scanned", by=["file"]), "scan")
    scratch.drop("scanned", "ranged", "placed", "ranges", "found")
    # the last separator before a range: by running maximum over one row per range
    prior = at.select("file", "block", F.when(F.col("seps") > 0, F.col("base") + F.array_max("ends")).alias("last"))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    prior = prior.select(F.col("file").alias("f"), F.col("block").alias("b"),
                         F.coalesce(F.max("last").over(earlier), F.lit(-1)).alias("prev"))
    rows = at.join(prior, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))
    inner = rows.where("seps > 0").select("file", "base", "before", "prev", F.posexplode(F.expr(
        "transform(ends, (e, i) -> struct(base + e as stop, if(i = 0, prev, base + ends[i - 1]) + 1 as start))")).alias("i", "d"))
    done = inner.select("file", (F.col("before") + F.col("i")).alias("ordinal"), F.col("d.start").alias("start"),
                        (F.col("d.stop") - F.col("d.start")).alias("n_tokens"))
    total = at.groupBy("file").agg(
        F.sum("n").alias("n"), F.sum("seps").alias("ordinal"),
        (F.coalesce(F.max(F.when(F.col("seps") > 0, F.col("base") + F.array_max("ends"))), F.lit(-1)) + 1).alias("start"))
    open_end = total.where("n > start").select("file", "ordinal", "start", (F.col("n") - F.col("start")).alias("n_tokens"))
    return done.unionByName(open_end)


def document_token_counts(docs: DataFrame, ranks_path: str, pattern: str, eod: int = 50256, dtype: str = "<u2",
                          text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, n_tokens``: writes the flat files, forgets the texts, counts by scanning the files.

    One row per input row, also for null ids and repeated rows; a null or
    empty text has 0 tokens; other columns are ignored; an empty table gives
    no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-counts")
    path = scratch.path("files")
    write_token_files(docs, path, ranks_path, pattern, eod, dtype, text, key)
    number = lambda file: F.regexp_extract(file, r"part-(\d+)-[^/]*$", 1).cast("long")
    if not _written(spark, path):       # no documents, no files
        return spark.createDataFrame([], "doc_id long, n_tokens long")
    listed = spark.read.option("lineSep", _mark(eod, dtype)).option("encoding", "ISO-8859-1").text(f"{path}/kind=ids").select(
        number(F.col("_metadata.file_path")).alias("p"), F.substring_index("value", ":", 1).cast("long").alias("first"),
        F.posexplode(F.split(F.expr("substring(value, instr(value, ':') + 1)"), ",")).alias("i", "id"))
    listed = scratch.store(listed.select("p", (F.col("first") + F.col("i")).alias("o"), F.col("id").try_cast("long").alias("doc_id")), "ids")
    counts = count_tokens(spark, f"{path}/kind=tokens", eod, scratch, dtype)
    counts = scratch.store(counts.select(number("file").alias("file"), "ordinal", "n_tokens"), "counts")
    scratch.drop("files", "scan")
    return listed.join(counts, (F.col("p") == F.col("file")) & (F.col("o") == F.col("ordinal"))).select("doc_id", "n_tokens")


def _written(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/kind=tokens")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
