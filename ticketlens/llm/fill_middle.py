"""Fill-in-the-middle rewriting as a pyarrow.compute pipeline.

A text is cut into units, runs of ASCII letters or single other characters.
Every batch is worked on as flat columns: a byte that UTF-8 never holds is put
behind each unit and split on, the list arrays are flattened with their parent
indices, a unit's ordinal is its place less its parent's first place, units are
filtered by the role that the ordinal gives them, and the pieces are rebuilt as
lists and joined.  No value passes through Python one at a time.

What is drawn for a row depends on its id and the seed alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 1
#: The three sentinels and the shares of the forms, in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
REWRITTEN = 90
SPM = 20
#: Texts are worked on in slices of about so many bytes (a longer text is a slice of its own).
SLICE_BYTES = 1 << 23

# one unit in UTF-8 bytes: letters, an ASCII character, or a lead byte with what follows it
_UNIT = rb"([A-Za-z]+|[\x00-\x7F]|[\xC0-\xFF][\x80-\xBF]*)"
_BREAK = b"\xff"
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
)
_COLUMNS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _joined(units: pa.Array, role: np.ndarray, wanted: int, lengths: np.ndarray) -> pa.Array:
    """The units of one role, filtered and joined per row; lengths: how many each row has of them."""
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), units.filter(pa.array(role == wanted)))
    return pc.binary_join(lists, pa.scalar(b"", pa.large_binary()))


def _text(pieces: pa.Array) -> pa.Array:
    return pieces.cast(pa.large_string())


def rewrite(ids: pa.Array, text: pa.Array, draws: list[np.ndarray]) -> pa.RecordBatch:
    """One slice: ids, texts without nulls (large_binary) and the four draws of each row."""
    h1, h2, h3, h4 = draws
    broken = pc.replace_substring_regex(text, pattern=_UNIT, replacement=rb"\1" + _BREAK)
    lists = pc.split_pattern(broken, pattern=_BREAK)  # an empty unit follows the last break
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64) - 1
    parent = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    units = pc.list_flatten(lists)
    first = np.concatenate([[0], np.cumsum(n + 1)])
    ordinal = np.arange(len(units)) - first[parent]
    cut_1, cut_2 = h1 % (n + 1), h2 % (n + 1)
    low, high = np.minimum(cut_1, cut_2), np.maximum(cut_1, cut_2)
    role = (ordinal >= low[parent]).astype(np.int8) + (ordinal >= high[parent]) + (ordinal >= n[parent])
    prefix = _joined(units, role, 0, low)
    middle = _joined(units, role, 1, high - low)
    suffix = _joined(units, role, 2, n - high)

    marked = np.zeros(len(n), bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= pc.match_substring(text, mark).to_numpy(zero_copy_only=False)
    plain = marked | (n == 0) | (h3 % 100 >= REWRITTEN)
    spm = ~plain & (h4 % 100 < SPM)
    p, s, m, none = (pa.scalar(x.encode(), pa.large_binary()) for x in (PREFIX, SUFFIX, MIDDLE, ""))
    psm_text = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    spm_text = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none)
    is_plain, is_spm = pa.array(plain), pa.array(spm)
    output = pc.if_else(is_plain, text, pc.if_else(is_spm, spm_text, psm_text))
    form = pc.if_else(is_plain, "plain", pc.if_else(is_spm, "spm", "psm"))

    def chars(pieces: pa.Array) -> pa.Array:
        return pc.if_else(is_plain, pa.scalar(None, pa.int64()), pc.utf8_length(_text(pieces)).cast(pa.int64()))

    columns = [ids, pa.array(n), form.cast(pa.string()), chars(prefix), chars(middle), _text(output).cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    start = 0
    while start < len(sizes):
        within = np.searchsorted(np.cumsum(sizes[start:]), SLICE_BYTES, side="right")
        yield start, max(1, int(within))
        start += max(1, int(within))


def _rewriter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = pc.fill_null(batch.column(1).cast(pa.large_binary()), b"")
        draws = [c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]]
        sizes = pc.binary_length(text).to_numpy(zero_copy_only=False)
        for start, count in _slices(sizes):
            yield rewrite(batch.column(0).slice(start, count), text.slice(start, count), [d[start : start + count] for d in draws])


def _draw(digest: Column, k: int) -> Column:
    """The k-th group of eight hex digits as a number."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output.

    A null text counts as empty, and an empty text stays plain, as does one
    that holds a sentinel.  A null id draws as an empty one.  Rows that repeat
    an id are drawn alike; an empty table gives an empty result.
    """
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.sha2(key, 256).alias("digest"))
    drawn = given.select("doc_id", "text", *[_draw(F.col("digest"), k).alias(f"h{k + 1}") for k in range(4)])
    return drawn.mapInArrow(_rewriter, _COLUMNS)


def restored(output: Column, form: Column) -> Column:
    """The text again.  No piece holds a sentinel, so the three marks are the only ones."""
    pieces = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)

    def piece(k: int) -> Column:
        return F.get(pieces, k)

    psm = F.concat(piece(1), piece(3), piece(2))
    spm = F.concat(piece(2), piece(3), piece(1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
