"""File names and first lines, by Spark's own listing and scans."""

import bz2
import gzip
import io
import re
import urllib.parse
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sinks.scratch import stored

# Schema of Spark's binaryFile source. Its content column is never selected, so no file is opened.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def literal_path(path: str) -> str:
    """Path that a Spark reader takes as it is, without reading [ ] { } * ? as a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def plain_path(uri: str) -> str:
    """A reader's URI of a file, spelled as `_metadata.file_path` is by `decoded_path`."""
    return re.sub("^file:/+", "file:/", urllib.parse.unquote(uri))


def _listing(spark: SparkSession, folder: str, pattern: str | None, **options) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).options(**options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder).select("path", "length")


def files_in(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """Path and length of the non-empty files below a folder; Spark distributes the listing."""
    return _listing(spark, folder, pattern)


def arriving_files(
    spark: SparkSession, folder: str, pattern: str | None, max_files: int
) -> DataFrame:
    """Stream of new files: path, length and the arrival time fixed by the micro-batch."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder).select("path", "length", F.current_timestamp().alias("arrived_at"))


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def exists(spark: SparkSession, name: str) -> bool:
    """Whether there is such a file or folder; a reader would answer by an error that Spark logs."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def present_and_missing(
    spark: SparkSession, paths: Sequence[str]
) -> tuple[list[str], list[str]]:
    """Of some file names: those that are there, as readers spell them, and the others as given.

    One listing if all are there; only around a missing one the list is halved.
    """
    if not paths:
        return [], []
    try:
        listed = spark.read.format("binaryFile").load([literal_path(path) for path in paths])
        return [plain_path(uri) for uri in listed.inputFiles()], []
    except AnalysisException as error:
        if not is_missing(error):
            raise
    if len(paths) == 1:
        return [], list(paths)
    half = len(paths) // 2
    first, second = (present_and_missing(spark, part) for part in (paths[:half], paths[half:]))
    return first[0] + second[0], first[1] + second[1]


def _newer(since: str | None) -> dict[str, str]:
    return {"modifiedAfter": since, "timeZone": "UTC"} if since else {}


def modified_files(
    spark: SparkSession, folder: str, pattern: str | None = None, since: str | None = None
) -> DataFrame:
    """Path and modification time of the non-empty files below a folder, modified after `since` (UTC)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    path = F.regexp_replace("path", "^file:/+", "file:/").alias("path")
    return reader.options(**_newer(since)).load(folder).select(path, "modificationTime")


def empty_files(
    spark: SparkSession, folder: str, pattern: str | None = None, since: str | None = None
) -> list[str]:
    """Zero-length files below a folder, modified after `since` (UTC), which no scan shows.

    The listing is Spark's and names empty files too; a scan of the same files names the others.
    """
    listing = _listing(spark, folder, pattern, **_newer(since))
    names = [(plain_path(uri),) for uri in listing.inputFiles()]
    if not names:
        return []
    listed = spark.createDataFrame(names, "listed string")
    filled = listing.select(F.regexp_replace("path", "^file:/+", "file:/").alias("listed"))
    return [row.listed for row in listed.join(filled, "listed", "left_anti").collect()]


# By file suffix: how to read what Hadoop's codecs wrote. Those under None are left to Spark.
UNPACKERS = {".gz": gzip.open, ".bz2": bz2.open}
UNPACKERS |= dict.fromkeys((".deflate", ".lz4", ".snappy", ".zst"))
FIRST_LINES = pa.schema([("file", pa.string()), ("header", pa.string()), ("opened", pa.bool_())])


def _stream(path: str, stores: dict) -> io.IOBase:
    """The file's bytes, through the store named by its scheme; `stores` keeps what was found out."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return open("/" + rest.lstrip("/"), "rb")
    uri = urllib.parse.quote(path.replace("s3a:", "s3:", 1), safe=":/@")
    store = urllib.parse.urlsplit(uri)[:2]
    if stores.get(store, True) is None:
        raise OSError(f"no access to {store}")
    stores[store] = None
    found, name = pyarrow.fs.FileSystem.from_uri(uri)
    stream = found.open_input_stream(name, compression=None)
    stores[store] = found
    return stream


def first_line(path: str, stores: dict) -> str | None:
    """The first line of a text file that is not blank; reads no further than the block it ends in."""
    suffix = re.search(r"(\.[^./]*)?$", path).group()
    unpack = UNPACKERS.get(suffix, lambda stream: stream)
    if unpack is None:
        raise OSError(f"{suffix} is left to Spark")
    with _stream(path, stores) as stream, unpack(stream) as plain:
        text = io.TextIOWrapper(plain, encoding="utf-8", errors="replace", newline=None)
        for line in text:
            if line.rstrip("\n").strip(" "):
                return line.rstrip("\n")
    return None


def _first_lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stores: dict = {}

    def found(path: str) -> tuple[str | None, bool]:
        try:
            return first_line(path, stores), True
        except (OSError, EOFError, ValueError, pa.ArrowException):
            return None, False

    for batch in batches:
        headers = [found(path) for path in batch.column("path").to_pylist()]
        columns = [batch.column("file").to_pylist(), [h for h, _ in headers], [o for _, o in headers]]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, FIRST_LINES.types)], schema=FIRST_LINES)


def header_lines(spark: SparkSession, source: str | Sequence[str]) -> DataFrame:
    """`file` and `header`, its first line that is not blank, of each text file below `source`.

    Tasks open the files that Spark lists and stop after that line, so what is read grows with the
    number of files and not with their length. If there is a file they cannot open, in a store only
    Spark can reach or packed in a way only Spark reads, all headers come from a scan. A file in which
    nothing stands has no row.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(source)
        .select(F.col("_metadata.file_path").alias("file"), "path")
    )
    found = stored(files.mapInArrow(_first_lines, "file string, header string, opened boolean"))
    if found.where(~F.col("opened")).isEmpty():
        return found.where("header IS NOT NULL").drop("opened")
    return scanned_header_lines(spark, source)


def scanned_header_lines(spark: SparkSession, source: str | Sequence[str]) -> DataFrame:
    """The same by a scan that splits all files into lines.

    The lines of a file's first block come in order, so the first is the one with the smallest id.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .text(source)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            "value",
        )
        .withColumn("place", F.monotonically_increasing_id())
    )
    return (
        lines.where((F.col("block") == 0) & (F.trim("value") != ""))
        .groupBy("file")
        .agg(F.min_by("value", "place").alias("header"))
    )


def drop_over(spark: SparkSession, source: str, target: str) -> None:
    """Move the part files of one folder over those of the same number in another."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())

    def parts(folder: str) -> dict:
        found = (status.getPath() for status in files.listStatus(path(folder)))
        return {at.getName()[:10]: at for at in found if at.getName().startswith("part-")}

    old = parts(target)
    for number, new in parts(source).items():
        files.delete(old[number], False)
        files.rename(new, old[number])


def one_store(spark: SparkSession, first: str, second: str) -> bool:
    """Whether two folders lie on one file system and neither in the other, so files can be moved."""
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    stores = [path(name).getFileSystem(conf) for name in (first, second)]
    if not stores[0].getUri().equals(stores[1].getUri()):
        return False
    one, other = (f"{fs.makeQualified(path(name)).toUri().getPath()}/" for fs, name in zip(stores, (first, second)))
    return not one.startswith(other) and not other.startswith(one)


def move_files(spark: SparkSession, paths: Iterable[str], folder: str) -> None:
    """Rename the files of a micro-batch to their whole path below a folder; gone ones are passed over."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def move(name: str) -> None:
        old = path(name)
        new = path(f"{folder.rstrip('/')}{old.toUri().getPath()}")
        store.mkdirs(new.getParent())
        if not store.rename(old, new) and store.exists(old):
            raise OSError(f"cannot move {name} below {folder}")

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, paths))
