"""Fill-in-middle: texts cut in three, their parts exchanged by rotations in place.

One scan over a text's bytes marks where its units begin (runs of A-Z and a-z, and every
other code point) and so finds both cuts. The sentinels are inserted in a bytearray, in the
order of the text; blocks are then exchanged by three reversals each, and going back makes
the same rotations the other way round. A reversal moves blocks of bounded size, so beside
the buffer nothing as long as the text is held, and UTF-8 is whole again after the third.

Which form a row gets, and where it is cut, depends on the hash of its id and seed alone.

Cases: a NULL or empty text is plain and gives the empty text. A text with a sentinel in it
stays plain, so that every output can be undone from itself and its form. A NULL id is hashed
as the empty string. Rows are transformed alone: repeated rows are equal again, rows that
share an id get equal draws, and an empty table gives no rows. Further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import ship

#: Before the prefix, the suffix and the middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Bytes that a reversal exchanges at once, and places of a scan counted together.
BLOCK = 65_536

_LETTER = np.zeros(256, bool)
_LETTER[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = True


def reverse(data: np.ndarray, low: int, high: int) -> None:
    """The bytes from ``low`` up to ``high`` the other way round, in place."""
    while high - low > 1:
        size = min(BLOCK, (high - low) // 2)
        head = data[low : low + size].copy()
        data[low : low + size] = data[high - size : high][::-1]
        data[high - size : high] = head[::-1]
        low, high = low + size, high - size


def rotate(buffer: bytearray, low: int, middle: int, high: int) -> None:
    """Exchanges the neighbours [low, middle) and [middle, high) by three reversals."""
    data = np.frombuffer(buffer, np.uint8)
    reverse(data, low, middle)
    reverse(data, middle, high)
    reverse(data, low, high)


class Scan:
    """Where the units and the code points of a text begin."""

    def __init__(self, text: bytes) -> None:
        data = np.frombuffer(text, np.uint8)
        letter = _LETTER[data]
        self.chars = (data & 0xC0) != 0x80
        self.units = self.chars.copy()
        self.units[1:] &= ~(letter[1:] & letter[:-1])
        blocks = range(0, len(data), BLOCK)
        counts = np.add.reduceat(self.units, blocks, dtype=np.int64) if len(data) else []
        self._before = np.r_[0, np.cumsum(counts, dtype=np.int64)]
        self.n = int(self._before[-1])

    def place(self, unit: int) -> int:
        """Bytes before this unit; before the one after the last, all bytes."""
        if unit >= self.n:
            return len(self.units)
        block = int(np.searchsorted(self._before, unit, "right")) - 1
        inside = np.flatnonzero(self.units[block * BLOCK : (block + 1) * BLOCK])
        return block * BLOCK + int(inside[unit - self._before[block]])

    def chars_in(self, low: int, high: int) -> int:
        return int(np.count_nonzero(self.chars[low:high]))


def draws(row_id: str, seed: int) -> list[int]:
    """Four numbers of 32 bits for a row."""
    digest = hashlib.sha256(f"{seed}:{row_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(
    text: bytes, numbers: Sequence[int], fim_percent: int, spm_percent: int, marks: Sequence[bytes]
) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of the prefix, of the middle, output) of one text."""
    scan = Scan(text)
    if not text or numbers[2] % 100 >= fim_percent or any(mark in text for mark in marks):
        return scan.n, "plain", None, None, text
    low, high = sorted(scan.place(h % (scan.n + 1)) for h in numbers[:2])
    prefix, suffix, middle = marks
    buffer = bytearray(text)
    buffer[high:high] = suffix
    buffer[low:low] = middle
    buffer[0:0] = prefix
    at_middle = low + len(prefix)
    at_suffix = high + len(prefix) + len(middle)
    rotate(buffer, at_middle, at_suffix, len(buffer))
    form = "psm"
    if numbers[3] % 100 < spm_percent:
        form = "spm"
        rotate(buffer, 0, at_middle, at_middle + len(buffer) - at_suffix)
    return scan.n, form, scan.chars_in(0, low), scan.chars_in(low, high), bytes(buffer)


def restore(output: bytes, form: str, marks: Sequence[bytes]) -> bytes:
    """The text of an output: the rotations inverted, the last one first."""
    if form == "plain":
        return output
    prefix, suffix, middle = marks
    buffer = bytearray(output)
    at_middle = buffer.find(middle)
    if form == "spm":
        rotate(buffer, 0, buffer.find(prefix), at_middle)
    at_suffix = buffer.find(suffix)
    rotate(buffer, at_suffix, at_middle, len(buffer))
    end = at_suffix + len(buffer) - at_middle  # of the middle; the suffix follows
    del buffer[end : end + len(suffix)]
    del buffer[at_suffix : at_suffix + len(middle)]
    del buffer[: len(prefix)]
    return bytes(buffer)


def _bytes(sentinels: Sequence[str]) -> list[bytes]:
    marks = [mark.encode() for mark in sentinels]
    if len(set(marks)) != 3 or any(a in b for a in marks for b in marks if a != b):
        raise ValueError("three sentinels are needed, none inside another")
    if any(mark[i:] == other[: len(mark) - i] for mark in marks for other in marks
           for i in range(1, len(mark))):
        raise ValueError("no sentinel may begin with the end of one")
    return marks


def fill_in_middle(
    docs: DataFrame,
    fim_percent: int = 90,
    spm_percent: int = 20,
    seed: int = 1,
    sentinels: Sequence[str] = SENTINELS,
) -> DataFrame:
    """doc_id, n, form (plain, psm or spm), prefix_chars, middle_chars and output of every row.

    ``fim_percent`` of the rows are transformed, ``spm_percent`` of those begin with the
    suffix. Both counts of code points are NULL for plain rows.
    """
    marks = _bytes(sentinels)
    ship(docs.sparkSession)
    kinds = {
        "n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(),
        "middle_chars": pa.int64(), "output": pa.binary(),
    }

    @F.arrow_udf("struct<n:long,form:string,prefix_chars:long,middle_chars:long,output:string>")
    def compute(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ids, texts in batches:
            rows = [
                transform(text, draws(row_id, seed), fim_percent, spm_percent, marks)
                for row_id, text in zip(ids.to_pylist(), texts.cast(pa.binary()).to_pylist())
            ]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, kinds.values())]
            columns[-1] = columns[-1].cast(pa.string())
            yield pa.StructArray.from_arrays(columns, list(kinds))

    made = compute(
        F.coalesce(docs["doc_id"].cast("string"), F.lit("")), F.coalesce(docs["text"], F.lit(""))
    )
    return docs.select("doc_id", made.alias("_made")).select("doc_id", "_made.*")


def restored(output: Column, form: Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text that ``fill_in_middle`` made this output of."""
    marks = _bytes(sentinels)

    @F.arrow_udf("string")
    def compute(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for outputs, forms in batches:
            texts = [
                None if text is None or form is None else restore(text, form, marks)
                for text, form in zip(outputs.cast(pa.binary()).to_pylist(), forms.to_pylist())
            ]
            yield pa.array(texts, pa.binary()).cast(pa.string())

    return compute(output, form)


def digests(transformed: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle`` with hashes in place of texts, one of the restored text."""
    text = restored(F.col("output"), F.col("form"))
    return transformed.withColumn("_restored", text).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("_restored").cast("binary"), 256).alias("restored_sha256"),
    )


ORACLE_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS c1,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS c2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS r3,
    CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS r4
  FROM units
), cut AS (
  SELECT doc_id, text, n,
    array_to_string(u[1:least(c1, c2)], '') AS prefix,
    array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
    array_to_string(u[greatest(c1, c2) + 1:], '') AS suffix,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR r3 >= 90 THEN 'plain' WHEN r4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""
