"""What the operators share: words, row keys, added columns, loading."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Words between the ASCII blanks, and words of digits, small letters and non-ASCII characters.
BLANK_WORDS = r"[^\x20\x09-\x0D]+"
PLAIN_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes that separate plain words become blanks; A-Z become small letters.
_PLAIN = bytes(
    (b | 32 if 65 <= b <= 90 else 32 if b < 48 or 58 <= b <= 96 or 123 <= b <= 127 else b)
    for b in range(256)
)


def ascii_lower(text: Column) -> Column:
    """A-Z in small letters; every other character as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def blank_words(text: bytes) -> list[bytes]:
    """Words of ``BLANK_WORDS``: bytes split at exactly the six ASCII blanks."""
    return text.split()


def plain_words(text: bytes) -> list[bytes]:
    """Words of ``PLAIN_WORDS`` in the lower-cased text."""
    return text.translate(_PLAIN).split()


#: Keys of rows without an id begin here; ids are below it.
NO_ID = 1 << 62


def row_key(id_column: str = "doc_id", text: str = "text") -> Column:
    """The id, or for a NULL id a number above all ids: 62 bits of a hash of the text."""
    content = F.xxhash64(F.col(text)).bitwiseAND(F.lit(NO_ID - 1))
    return F.coalesce(F.col(id_column).cast("bigint"), F.lit((1 << 63) - 1) - content)


# --- hashes of words and runs of words ---------------------------------------------------

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> np.uint64(31))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words; empty if there are fewer words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = words[:n].copy()
    for j in range(1, k):
        total *= _A
        total += words[j : j + n]
    return mix(total)


class RunHashes:
    """Hash of any run of words of one text, from sums of powers: constant time a run."""

    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        if len(RunHashes._powers) <= n:
            size = max(4096, 2 * n)
            step = np.full(size, _A, np.uint64)
            back = np.full(size, np.uint64(pow(int(_A), -1, 1 << 64)), np.uint64)
            step[0] = back[0] = 1
            RunHashes._powers, RunHashes._inverse = np.cumprod(step), np.cumprod(back)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * RunHashes._powers[:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        run = (self.sums[end] - self.sums[start]) * RunHashes._inverse[start]
        return mix(run + mix((end - start).astype(np.uint64)))


# --- Python passes -----------------------------------------------------------------------

Cells = Callable[[pa.RecordBatch], list]
#: Bytes of texts that a Python pass takes in one go; a longer text is one slice.
SLICE = 2 << 20


def _cell_bytes(column: pa.Array) -> np.ndarray:
    """Bytes of each cell of a text column; 8 for any other."""
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        return np.diff(ends.astype(np.int64))
    return np.full(len(column), 8, np.int64)


def slices(batch: pa.RecordBatch, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes, so that memory follows bytes and not rows.

    Spark bounds a batch by its rows: ten thousand long texts may be in one.
    """
    if batch.num_rows == 0:
        return
    size = sum(map(_cell_bytes, batch.columns), np.zeros(batch.num_rows, np.int64))
    run = (np.cumsum(size) - size) // limit
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(start, end - start)


def add_columns(df: DataFrame, function: Callable[[], Cells], added: str, keep: list[str] | None = None, limit: int = SLICE) -> DataFrame:
    """One Arrow pass that adds columns to the rows.

    ``function()`` is called once per task and gives a function from a record batch, of at
    most some ``limit`` bytes or one row, to the added columns, as Python lists or Arrow arrays. ``keep`` names the columns of ``df``
    that stay, all by default. Rows stay in place: there is no shuffle.
    """
    names = df.columns if keep is None else keep
    extra = StructType.fromDDL(added)
    schema = StructType([*(df.schema[n] for n in names), *extra.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        cells, types = function(), [to_arrow_type(f.dataType) for f in extra.fields]
        for batch in (part for whole in batches for part in slices(whole, limit)):
            made = [
                c if isinstance(c, pa.Array) else pa.array(c, t)
                for c, t in zip(cells(batch), types, strict=True)
            ]
            old = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*old, *made], [f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str) -> Iterator[bytes | None]:
    """The texts of a batch as UTF-8, one at a time."""
    for cell in batch.column(batch.schema.get_field_index(column)):
        value = cell.as_py()
        yield value.encode("utf-8", "surrogatepass") if isinstance(value, str) else value


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_``, ``name__`` ... that no column has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def load(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def long_of(x: np.ndarray) -> np.ndarray:
    """Unsigned hashes as the signed numbers that Spark stores."""
    return x.view(np.int64)


def letters(text: Column) -> Column:
    """Whether the text has a letter of any script."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def regex_words(text: Column, pattern: str) -> Column:
    """All words of a text, in the JVM; none for NULL."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.array().cast("array<string>"))


_TRAILING = re.compile(r"\s+")


def one_line(sql: str) -> str:
    """SQL on one line."""
    return _TRAILING.sub(" ", sql).strip()
