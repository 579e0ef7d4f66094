"""Raw review dumps: ``key: value`` lines, a blank line between records.

Reading: the text source splits files on ``\\n\\n`` (Hadoop's delimited line
reader, so large files split across tasks and records crossing a split
boundary are handled by the reader).  Inside each chunk, line breaks are
normalised and the chunk is split again on whitespace-only lines, so runs of
blank lines and blank-looking separators give no empty record.  One regular
expression pass per block collects the lines that start with a known key;
each column then takes the last of its lines (a repeated key: last wins).
Everything is one narrow stage - no shuffle.

The separator decides only where a file may be split into tasks: whatever it is,
chunks are split again into the same records.  Without ``line_sep`` it is found
per file, from the file's first ``PROBE_BYTES`` (:func:`separators`), and files
of one separator are one scan; a CRLF dump, say, splits across tasks as any other.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.numbers import UNKNOWN_PRICE, parse_epoch, parse_float, parse_price
from revlens.functions.text import strip_quotes
from revlens.schema import REVIEW_COLUMNS

# Raw key of each review column, in record order.
RAW_KEYS = {
    "product_id": "product/productId:",
    "title": "product/title:",
    "price": "product/price:",
    "user_id": "review/userId:",
    "user_name": "review/profileName:",
    "helpfulness": "review/helpfulness:",
    "rating": "review/score:",
    "review_time": "review/time:",
    "review_summary": "review/summary:",
    "review_text": "review/text:",
}

# The characters a line strip removes (Python ``str.strip``
# whitespace), as a literal set and as a regular-expression class.
_WS_CHARS = (" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
             "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
_WS = "[\\s\\x{1C}-\\x{1F}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
_RECORD_BREAK = "\\n" + _WS + "*\\n"
# (?d): only \n ends a line; (?m): ^ and $ per line.  One pass collects every
# line that starts (after blanks) with a known key, blanks removed; no key is
# a prefix of another, so each collected line belongs to exactly one key.
_KEY_LINES = ("(?dm)^" + _WS + "*((?:" + "|".join("\\Q" + k + "\\E" for k in RAW_KEYS.values()) + ").*)$")


def _strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_WS_CHARS))


def _raw_value(key_lines: Column, key: str) -> Column:
    """Text after ``key`` on the last line starting with it, up to a repeat of the key."""
    # last line wins; no line (key absent) gives null
    last = F.try_element_at(F.filter(key_lines, lambda line: line.startswith(key)), F.lit(-1))
    return _strip(F.substring_index(F.substring(last, F.lit(len(key) + 1), F.length(last)), key, 1))


# bytes read of each file to find its separator, and separators that get a scan of their own
PROBE_BYTES = 1 << 16
MAX_SCANS = 8
DEFAULT_SEPARATOR = "\n\n"
# two line ends of one kind with nothing but blanks between them
_BREAK = re.compile(rb"(\r\n|\n|\r)[ \t]*\1")


def separator_of(head: bytes) -> str:
    """The most frequent record break in the first bytes of a dump (none: ``DEFAULT_SEPARATOR``)."""
    found = Counter(m.group() for m in _BREAK.finditer(head))
    # of equally frequent ones that found first
    return found.most_common(1)[0][0].decode() if found else DEFAULT_SEPARATOR


def separators(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The data files under ``path`` (a file, folder or glob) by their separator.

    The driver reads ``PROBE_BYTES`` of every file, one after the other; compressed files keep the default,
    as they are not split anyway.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop
    root = hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    codecs = hadoop.io.compress.CompressionCodecFactory(conf)
    found = defaultdict(list)
    for top in fs.globStatus(root) or []:
        files = fs.listFiles(top.getPath(), True)
        while files.hasNext():
            status = files.next()
            file = status.getPath()
            inside = file.toString()[len(top.getPath().toString()):].split("/")
            if any(part.startswith(("_", ".")) for part in inside) or not status.getLen():
                continue
            sep = DEFAULT_SEPARATOR
            if codecs.getCodec(file) is None:
                stream = fs.open(file)
                try:
                    sep = separator_of(jvm.org.apache.commons.io.IOUtils.toByteArray(
                        stream, int(min(status.getLen(), PROBE_BYTES))))
                finally:
                    stream.close()
            found[sep].append(file.toString())
    return dict(found)


def read_raw_blocks(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """One row per record block: ``block`` text and ``file_name``; the separator is found unless it is given."""
    if line_sep is not None:
        return split_blocks(spark.read.option("lineSep", line_sep).text(path))
    found = separators(spark, path)
    if len(found) <= 1:
        return read_raw_blocks(spark, path, next(iter(found), DEFAULT_SEPARATOR))
    rare = sorted(found, key=lambda s: (-len(found[s]), s))[MAX_SCANS - 1:]
    left = [f for s in rare if s != DEFAULT_SEPARATOR for f in found.pop(s)]
    if left:
        found.setdefault(DEFAULT_SEPARATOR, []).extend(left)
    # the partition columns of the whole folder, whatever files a scan has
    columns = spark.read.text(path).schema
    base = {} if re.search(r"[*?\[{]", path) else {"basePath": path}
    out = None
    for sep, files in sorted(found.items()):
        part = split_blocks(spark.read.schema(columns).options(**base).option("lineSep", sep).text(files))
        out = part if out is None else out.unionByName(part)
    return out


def split_blocks(chunks: DataFrame) -> DataFrame:
    """Record blocks of the text source's chunks (batch or streaming)."""
    text = F.regexp_replace(F.col("value"), "\\r\\n?", "\n")
    # partition columns of a partitioned folder (e.g. category=...) are kept
    extra = [c for c in chunks.columns if c != "value"]
    return chunks.select(
        F.explode(F.split(text, _RECORD_BREAK)).alias("block"),
        F.col("_metadata.file_name").alias("file_name"),
        *extra,
    )


def parse_blocks(blocks: DataFrame, block_col: str = "block", keep_raw: bool = False) -> DataFrame:
    """key/value extraction and typing of record blocks.

    Blocks without any known key are no record and are dropped.  ``price``
    ``unknown`` becomes null; other unparsable numbers become null too, and
    ``keep_raw=True`` keeps their text in ``raw_*`` columns so that
    :func:`count_rejects` can report them.
    """
    extra = [c for c in blocks.columns if c != block_col]
    # one regex pass per block; a block without any key line is no record.  The
    # key lines come out of a one-row generator so that the emptiness filter
    # stays above it instead of re-running the regex inside the filter.
    found = F.struct(F.regexp_extract_all(F.col(block_col), F.lit(_KEY_LINES), 1).alias("_lines"), *extra)
    lines = blocks.select(F.inline(F.array(found)))
    raw = lines.filter(F.size("_lines") > 0).select(
        *[_raw_value(F.col("_lines"), k).alias("raw_" + c) for c, k in RAW_KEYS.items()], *extra
    )
    r = {c: F.col("raw_" + c) for c in RAW_KEYS}
    typed = [
        r["product_id"].alias("product_id"),
        r["title"].alias("title"),
        parse_price(r["price"]).alias("price"),
        r["user_id"].alias("user_id"),
        strip_quotes(r["user_name"]).alias("user_name"),
        r["helpfulness"].alias("helpfulness"),
        parse_float(r["rating"]).alias("rating"),
        parse_epoch(r["review_time"]).alias("review_time"),
        r["review_summary"].alias("review_summary"),
        r["review_text"].alias("review_text"),
    ]
    cols = typed + [F.col(c) for c in extra]
    if keep_raw:
        cols += [F.col("raw_price"), F.col("raw_rating"), F.col("raw_review_time")]
    return raw.select(*cols)


def count_rejects(parsed_raw: DataFrame) -> DataFrame:
    """One row: records, and numbers present but unparsable (the reference aborts on them)."""
    return parsed_raw.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("raw_price").isNotNull() & (F.col("raw_price") != UNKNOWN_PRICE) & F.col("price").isNull()).alias("bad_price"),
        F.count_if(F.col("raw_rating").isNotNull() & F.col("rating").isNull()).alias("bad_rating"),
        F.count_if(F.col("raw_review_time").isNotNull() & F.col("review_time").isNull()).alias("bad_review_time"),
    )


def category_of(file_name: Column | str) -> Column:
    """Category of a dump: its file name without extension, percent escapes of the file URI decoded."""
    name = F.col(file_name) if isinstance(file_name, str) else file_name
    stem = F.regexp_replace(name, "\\.[^.]*$", "")
    # a plus sign is not an escape in a path, but would be one to url_decode
    return F.url_decode(F.regexp_replace(stem, "\\+", "%2B"))


def read_raw_reviews(
    spark: SparkSession, path: str, category: str | None = None, line_sep: str | None = None
) -> DataFrame:
    """S1+S2: raw dump(s) -> typed review rows.

    ``category`` defaults to the file name without its extension (one file
    per category, as the dumps come).
    """
    parsed = parse_blocks(read_raw_blocks(spark, path, line_sep))
    cat = F.lit(category) if category is not None else category_of("file_name")
    return parsed.withColumn("category", cat).drop("file_name")


def raw_block() -> Column:
    """One raw block per review row (null price -> ``unknown``, other nulls -> line left out)."""
    lines = []
    for c in REVIEW_COLUMNS:
        v = F.col(c).cast("string")
        if c == "price":
            v = F.coalesce(v, F.lit(UNKNOWN_PRICE))
        lines.append(F.concat(F.lit(RAW_KEYS[c] + " "), v))
    return F.concat_ws("\n", *lines)


def write_raw(df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = None,
              compression: str | None = None) -> None:
    """Write reviews as a raw dump (blocks separated by a blank line), optionally
    one folder per value of ``partition_by`` (e.g. one dump per category).

    ``compression`` (e.g. ``gzip``): such files are each read by one task, so they should be of bounded size."""
    extra = [partition_by] if partition_by else []
    writer = df.select(raw_block().alias("value"), *extra).write.mode(mode).option("lineSep", "\n\n")
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.text(path)
