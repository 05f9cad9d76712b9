"""Corpus sources.

A *corpus* is a DataFrame ``(doc_id, class, text)`` plus any ordering columns.
``doc_id`` is the sample name (file name, line number or a table key).
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textlens.functions.text import WHITESPACE_JAVA
from textlens.session import saved


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table_corpus(df: DataFrame, id_col: str, class_col: str, text_col: str = "text") -> DataFrame:
    """Any table as a corpus. Only the three columns are read (column pruning)."""
    return df.select(
        F.col(id_col).alias("doc_id"), F.col(class_col).cast("string").alias("class"), F.col(text_col).alias("text")
    )


def documents_corpus(spark: SparkSession, sf_dir: str, class_col: str = "lang") -> DataFrame:
    """``documents`` with class = ``lang`` or ``source``."""
    return table_corpus(spark.read.parquet(table_path(sf_dir, "documents")), "doc_id", class_col)


def quality_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels`` joined to ``documents``; class = ``quality`` as text ('0'/'1')."""
    labels = spark.read.parquet(table_path(sf_dir, "labels")).select("doc_id", "quality")
    docs = spark.read.parquet(table_path(sf_dir, "documents")).select("doc_id", "text")
    return labels.join(docs, "doc_id").select(
        "doc_id", F.col("quality").cast("string").alias("class"), "text"
    )


def conversations_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` with class = ``role``; sample id ``'<conv_id>-<turn>'``.

    Ordering columns ``conv_id, turn`` are kept for the split.
    """
    c = spark.read.parquet(table_path(sf_dir, "conversations"))
    return c.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("doc_id"),
        F.col("role").alias("class"),
        "text",
        "conv_id",
        "turn",
    )


def decoded(part: Column, times: int = 1) -> Column:
    """A part of a file's path without URL escapes; the decoder would turn a plus into a space."""
    for _ in range(times):
        part = F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))
    return part


def folder_corpus(spark: SparkSession, root: str, partitioned: bool = False) -> DataFrame:
    """``<root>/<class>/<sample>`` text files, whole text per file.

    Only the class folders are listed here; tasks list each of them, and the names are dealt over tasks that read the
    files, so neither driver nor a single task handles all files. Stores that ``pyarrow.fs`` does not open are read by
    Spark's own readers. Those pass over names that start with ``_`` or ``.``; if the folders
    hold any, this raises instead of losing a sample (job markers and checksums of Spark's own aside).
    ``partitioned``: the layout Spark itself writes with
    ``partitionBy("class", "doc_id")``: ``class=<c>/doc_id=<d>/part-*``.
    """
    if (opened := folder_store(root)) is not None:
        return _listed_corpus(spark, *opened, partitioned)
    path = F.col("_metadata.file_path")

    def name(pattern, times=1):
        return decoded(F.regexp_extract(path, pattern, 1), times)

    if partitioned:
        raw = spark.read.text(root.rstrip("/") + "/*/*/*", wholetext=True)
        return raw.select(
            # escaped once as a partition value and once as a path
            name(r"doc_id=([^/]+)/[^/]+$", 2).alias("doc_id"),
            name(r"class=([^/]+)/doc_id=[^/]+/[^/]+$", 2).alias("class"),
            F.col("value").alias("text"),
        )
    hidden = hidden_names(spark, root)
    if hidden:
        raise _unread(hidden)
    raw = whole_files(spark, root, "/*/*")
    return raw.select(F.regexp_extract("file", r"([^/]+)$", 1).alias("doc_id"), F.regexp_extract("file", r"([^/]+)/[^/]+$", 1).alias("class"), "text")


def _unread(hidden: list[str]) -> ValueError:
    return ValueError(f"Spark does not read samples whose names start with '_' or '.': {', '.join(hidden)}")


def folder_store(root: str):
    """``(store, path)`` of a folder by ``pyarrow.fs``; ``None`` if that does not open its address."""
    from pyarrow import fs

    root = root.rstrip("/")
    if "://" not in root and not root.startswith("file:"):
        return fs.LocalFileSystem(), root
    try:
        return fs.FileSystem.from_uri(root)
    except (pa.ArrowException, OSError):
        return None


#: Files of a partition at most, about, and bytes of texts in one batch.
PACKED_FILES, BATCH_BYTES = 4096, 8 << 20


def is_hidden(name: str) -> bool:
    """Whether Spark's readers pass over a name."""
    return name[0] in "._"


def is_marker(name: str) -> bool:
    """Whether a name is one of Spark's own job markers and checksums."""
    return name in ("_SUCCESS", "_temporary") or name.endswith(".crc")


def _listed_corpus(spark: SparkSession, store, base: str, partitioned: bool) -> DataFrame:
    """``folder_corpus`` of a store that tasks open: names first (saved), then the texts."""
    from pyarrow import fs

    kind = "path string, name string, size long, hidden boolean"

    def entries(folder):
        return store.get_file_info(fs.FileSelector(folder, allow_not_found=True))

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for folder in b.column(0).to_pylist():
                outside = is_hidden(folder.rsplit("/", 1)[1])
                found = []
                for x in entries(folder):
                    if x.type == fs.FileType.Directory and not partitioned and not is_hidden(x.base_name):
                        found += [(y, is_hidden(y.base_name)) for y in entries(x.path) if y.type == fs.FileType.File]
                    else:
                        found.append((x, outside or is_hidden(x.base_name)))
                rows = [(x.path, x.base_name, x.size or 0, hidden) for x, hidden in found if not (hidden and is_marker(x.base_name))]
                for i in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), t) for c, t in zip(zip(*rows[i : i + 10_000]), (pa.string(), pa.string(), pa.int64(), pa.bool_()))],
                        ["path", "name", "size", "hidden"],
                    )

    classes = [(x.path,) for x in entries(base) if x.type == fs.FileType.Directory]  # a row a class
    folders = spark.createDataFrame(classes, "folder string").repartition(max(1, len(classes)), "folder")
    names = saved(folders.mapInArrow(listing, kind), "folder-files")
    if not partitioned:
        hidden = names.where("hidden").select("path").limit(5).collect()
        if hidden:
            raise _unread([r["path"] for r in hidden])
    names = names.where("not hidden")
    n, size = names.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = max(spark.sparkContext.defaultParallelism, n // PACKED_FILES, size // PACKED_BYTES)

    def samples(path):
        """(name, class, file) of the files of a row of ``names``."""
        if not partitioned:
            folder, name = path.rsplit("/", 2)[1:]
            yield name, folder, path
            return
        cls, name = (unquote(part.partition("=")[2]) for part in path.rsplit("/", 2)[1:])
        for x in entries(path):
            if x.type == fs.FileType.File and x.size and not is_hidden(x.base_name):
                yield name, cls, x.path

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in zip(*rows)], ["doc_id", "class", "text"])

        for b in batches:
            for path in b.column(0).to_pylist():
                for name, cls, file in samples(path):
                    with store.open_input_stream(file) as f:
                        text = f.read()
                    rows.append((name, cls, text.decode("utf-8", "replace")))
                    size += len(text)
                    if size >= BATCH_BYTES:
                        yield flush()
                        rows, size = [], 0
        if rows:
            yield flush()

    return names.select("path").repartition(int(parts), "path").mapInArrow(read, "doc_id string, class string, text string")


#: Bytes of small files that are read in one partition.
PACKED_BYTES = 64 << 20


def whole_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """``(file, text)`` of each file, empty ones too (the table readers leave those out), many to a partition."""
    jvm, root = spark._jvm, root.rstrip("/")
    folder = jvm.org.apache.hadoop.fs.Path(root)
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    strings = jvm.org.apache.spark.sql.Encoders.STRING()
    files = spark._jsc.wholeTextFiles(root + pattern, max(spark.sparkContext.defaultParallelism, size // PACKED_BYTES))
    rows = spark._jsparkSession.createDataset(jvm.org.apache.spark.api.java.JavaPairRDD.toRDD(files), jvm.org.apache.spark.sql.Encoders.tuple(strings, strings))
    return DataFrame(rows.toDF(), spark).toDF("file", "text")


def hidden_names(spark: SparkSession, root: str, limit: int = 5) -> list[str]:
    """Some of the samples and classes under ``root`` that Spark's readers would pass over."""
    fs = spark._jvm.org.apache.hadoop.fs
    found = []
    for pattern in ("/[._]*/*", "/*/[._]*"):
        path = fs.Path(root.rstrip("/") + pattern)
        for status in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []:
            name = status.getPath().getName()
            if not is_marker(name) and len(found) < limit:
                found.append(status.getPath().toString())
    return found


def write_plain_folders(corpus: DataFrame, root: str) -> None:
    """Write a corpus as ``<root>/<class>/<name>``, one text file a sample, on any store that ``pyarrow.fs`` opens by
    its address. A retried task writes the same files again. Names must be usable as file names that Spark reads."""
    opened = folder_store(root)
    if opened is None:
        raise ValueError(f"no store for {root!r}")
    store, base = opened

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, known = 0, set()
        for b in batches:
            for cls, name, text in zip(*(c.to_pylist() for c in b.columns)):
                for part in (cls, name):
                    if not part or "/" in part or part[0] in "._":
                        raise ValueError(f"{part!r} is no file name that can be read back")
                if cls not in known:
                    store.create_dir(f"{base}/{cls}", recursive=True)
                    known.add(cls)
                with store.open_output_stream(f"{base}/{cls}/{name}") as out:
                    out.write((text or "").encode())
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]})

    named = corpus.select("class", F.col("doc_id").cast("string").alias("doc_id"), "text")
    named.mapInArrow(write, "n long").agg(F.sum("n")).collect()  # runs the tasks


#: What Spark escapes in the folder names of partition values.
_ESCAPED = {c: f"%{c:02X}" for c in [*range(1, 32), 127, *map(ord, '"#%\'*/:=?\\{[]^')]}


def partition_folder(column: str, value: str | None) -> str:
    """The folder that Spark names for a partition value."""
    return f"{column}={value.translate(_ESCAPED) if value else '__HIVE_DEFAULT_PARTITION__'}"


def write_folder_corpus(corpus: DataFrame, root: str) -> None:
    """Write a corpus as one text file per sample under ``class=<c>/doc_id=<d>/``, over what is there: the layout of
    Spark's ``partitionBy("class", "doc_id").text``, rows of a task with the same class and name in one file. Each task
    puts its files where they stay; Spark's committer would move them one after the other on the driver. A retried task
    writes the same files again. Stores that ``pyarrow.fs`` does not open are left to Spark's writer."""
    named = corpus.select("class", F.col("doc_id").cast("string").alias("doc_id"), "text")
    if (opened := folder_store(root)) is None:
        named.write.mode("overwrite").partitionBy("class", "doc_id").text(root)
        return
    store, base = opened
    store.create_dir(base, recursive=True)
    store.delete_dir_contents(base)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, out, n = TaskContext.get().partitionId(), None, None, 0
        for b in batches:
            for cls, name, text in zip(*(c.to_pylist() for c in b.columns)):
                if (cls, name) != now:
                    if out:
                        out.close()
                    folder = f"{base}/{partition_folder('class', cls)}/{partition_folder('doc_id', name)}"
                    store.create_dir(folder, recursive=True)
                    out, now = store.open_output_stream(f"{folder}/part-{part:05d}.txt", compression=None), (cls, name)
                out.write(((text or "") + "\n").encode())
                n += 1
        if out:
            out.close()
        yield pa.RecordBatch.from_pydict({"n": [n]})

    sorted_ = named.sortWithinPartitions("class", "doc_id")
    sorted_.mapInArrow(write, "n long").agg(F.sum("n")).collect()  # runs the tasks
    store.open_output_stream(f"{base}/_SUCCESS").close()


def folder_target(corpus: DataFrame) -> DataFrame:
    """S3: numeric target per class, classes numbered alphabetically from 0."""
    from pyspark.ml.feature import StringIndexer

    idx = StringIndexer(inputCol="class", outputCol="target", stringOrderType="alphabetAsc")
    return idx.fit(corpus).transform(corpus)


#: Byte ranges of text files whose line counts are broadcast; more are joined by a shuffle.
BROADCAST_RANGES = 250_000


def text_lines(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """S2 input: lines of text files as ``(source, line_no, line)``, blank lines included.

    ``line_no`` is the 0-based line index within its file, ``source`` the file's name. With ``parts`` a
    source is a folder of part files, in the order of their names, as Spark writes a large file.

    Spark's reader cuts files into byte ranges and reads each in order. A line is numbered inside its range
    as it is read, and a running sum of the ranges' line counts, by file and range start, gives the range its
    first number. So the numbers do not depend on how the files were split or where a range was read, and
    no line is shuffled or sorted.
    """
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    raw = spark.read.text(path)
    ranges = saved(raw.groupBy(file.alias("file"), start.alias("start")).agg(F.count(F.lit(1)).alias("n")), "line-ranges")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n = None, 0
        for b in batches:
            files, starts = b.column(0).to_pylist(), b.column(1).to_pylist()
            at = []
            for here in zip(files, starts):
                if here != now:
                    now, n = here, 0
                at.append(n)
                n += 1
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, pa.int64()), b.column(2)], ["file", "start", "at", "line"])

    numbered = raw.select(file.alias("file"), start.alias("start"), F.col("value").alias("line")).mapInArrow(
        number, "file string, start long, at long, line string"
    )
    source = F.regexp_extract("file", r"([^/]+)/[^/]+$" if parts else r"([^/]+)$", 1)
    whole = F.regexp_extract("file", r"^(.*)/[^/]+$", 1) if parts else F.col("file")
    # ranges of a file: one for each ``spark.sql.files.maxPartitionBytes`` of it
    before = Window.partitionBy("whole").orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    first = ranges.withColumn("whole", whole).withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    first = first.select("file", "start", "first")
    if ranges.count() <= BROADCAST_RANGES:
        first = F.broadcast(first)
    return numbered.join(first, ["file", "start"]).select(
        decoded(source).alias("source"), (F.col("first") + F.col("at")).alias("line_no"), "line"
    )


def write_lines(lines: DataFrame, root: str) -> None:
    """Write ``(source, line_no, line)`` as ``<root>/<source>/part-*``: the lines of a source run through its
    part files in the order of their names."""
    for r in lines.select("source").distinct().toLocalIterator():  # one name for each file
        mine = lines.where(F.col("source") == r["source"]).repartitionByRange("line_no").sortWithinPartitions("line_no")
        mine.select("line").write.text(f"{root.rstrip('/')}/{r['source']}")


def labelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the labelled-line files built from ``labels`` ⋈ ``documents``.

    One line per labelled document: its text on one line, a tab, then the
    ``quality`` label. ``line_no`` = rank of ``doc_id`` (0-based).
    """
    from textlens.operators.sampling import rank_within

    labels = spark.read.parquet(table_path(sf_dir, "labels")).select("doc_id", "quality")
    docs = spark.read.parquet(table_path(sf_dir, "documents")).select("doc_id", "text")
    # only the keys are ranked; each text is read once and joined to its number
    keys = labels.join(docs.select("doc_id"), "doc_id").withColumn("source", F.lit("labels"))
    ranked = rank_within(keys, "source", ["doc_id"])
    line = F.concat(F.regexp_replace("text", WHITESPACE_JAVA, " "), F.lit("\t"), F.col("quality").cast("string"))
    return docs.join(ranked, "doc_id").select("source", (F.col("rn") - 1).alias("line_no"), line.alias("line"))
