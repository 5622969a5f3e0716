"""Fill-in-the-middle examples by repeated-capture matching.

A text is a run of units: a word of ASCII letters, or any other single
character. One ``fullmatch`` of ``(unit)*`` with the ``regex`` library keeps
every repetition of the group, so ``match.ends(1)`` is the list of all unit
ends: its length is the number of units, and the two cuts of a text are two of
its items. Both cuts and the form of a document come from a hash of its id.

Forms: ``psm`` is <P>prefix<S>suffix<M>middle, ``spm`` is
<S>suffix<P>prefix<M>middle, ``plain`` the text itself (for an empty text, a
text that holds one of the three markers, and a share of all others). A text
that is cut holds no marker, so splitting the output at its markers gives the
three pieces back.

A match keeps some hundred bytes per unit, so a text is matched in regions of
about ``REGION`` characters (almost always one), which end between units.

Defined cases: null text counts as empty; a null id is hashed as an empty
string, repeated ids get the same cuts if their texts are equal; an empty table
gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fishladder.llm.common import documents, prepare_workers

MARKERS = ("<P>", "<S>", "<M>")
FIM_PERCENT = 90
SPM_PERCENT = 20
REGION = 1 << 20

_UNITS = regex.compile(r"([A-Za-z]+|[^A-Za-z])*")
_LETTERS = regex.compile(r"[A-Za-z]*")


def draws(doc_id, seed: int = 1) -> list[int]:
    """Four unsigned 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]


def regions(text: str, length: int = REGION):
    """(start, end) of the regions of a text; a word of letters is never divided."""
    start = 0
    while start < len(text):
        end = min(start + length, len(text))
        if "A" <= text[end - 1] <= "Z" or "a" <= text[end - 1] <= "z":
            end = _LETTERS.match(text, end).end()
        yield start, end
        start = end


def cuts(text: str, one: int, two: int, length: int = REGION) -> tuple[int, int, int]:
    """(units, end of the prefix, end of the middle) of a text; ``one`` and
    ``two`` are taken modulo the number of possible cuts."""
    spans, ends, counts = list(regions(text, length)), [], []
    for start, end in spans:
        ends = _UNITS.fullmatch(text, start, end).ends(1)
        counts.append(len(ends))
    n = sum(counts)
    places = []
    for unit in sorted((one % (n + 1), two % (n + 1))):
        at, left = 0, unit
        for (start, end), count in zip(spans, counts):
            if left <= count:
                if left:
                    own = ends if len(spans) == 1 else _UNITS.fullmatch(text, start, end).ends(1)
                    at = own[left - 1]
                break
            at, left = end, left - count
        places.append(at)
    return n, *places


def example(doc_id, text: str, seed: int = 1, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> tuple:
    """(units, form, prefix characters, middle characters, output) of one document."""
    one, two, form, order = draws(doc_id, seed)
    n, a, b = cuts(text, one, two)
    if not text or any(m in text for m in MARKERS) or form % 100 >= fim_percent:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = MARKERS
    if order % 100 < spm_percent:
        return n, "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def fill_in_middle(df: DataFrame, seed: int = 1, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output for every row."""
    prepare_workers(df.sparkSession)
    src = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def transform(batches):
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            rows = [example(i, t, seed, fim_percent, spm_percent)
                    for i, t in zip(batch.column(0).to_pylist(), (t.as_py() for t in batch.column(1)))]
            made = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made],
                                             names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return src.mapInArrow(transform, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n long, form string, "
                                     "prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text an example was made of."""
    pieces = F.split(output, "<[PSM]>", -1)
    return (F.when(form == "psm", F.concat(pieces[1], pieces[3], pieces[2]))
             .when(form == "spm", F.concat(pieces[2], pieces[3], pieces[1])).otherwise(output))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(documents(spark, sf_dir))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP11_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents),
drawn AS (
  SELECT doc_id, t, u, len(u) AS n,
         ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2,
         ('0x' || h[17:24])::UBIGINT AS h3, ('0x' || h[25:32])::UBIGINT AS h4
  FROM units),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
pieces AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m,
         array_to_string(u[b + 1:], '') AS s
  FROM cut)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM pieces
"""
