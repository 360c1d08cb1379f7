"""Fill-in-middle transformation by a regular expression with counted quantifiers.

``regexp_count`` gives a text's number of units n.  Seeds from the document's id pick two cuts, and
the row's own pattern ``(unit{a}+)(unit{b-a}+)(rest)`` captures prefix, middle and suffix in one
match, whose replacement string writes the output.  The counted groups are possessive: a matched
unit is never given back, so the matcher loops instead of recursing and a text of any length fits.
Everything is one projection of Spark SQL expressions: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A unit is a word with the white space before it, or white space that no word follows.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = "42:"


def seeds(doc_id: Column) -> list[Column]:
    """h1 to h4: the first four 8-digit groups of the sha256 of the seed and the id, as long."""
    digest = F.sha2(F.concat(F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def cut_pattern(first: Column, second: Column) -> Column:
    """The row's pattern: ``first`` units, then ``second`` units, then the rest."""
    return F.concat(F.lit(rf"(?s)\A((?:{UNIT}){{"), first.cast("string"), F.lit(rf"}}+)((?:{UNIT}){{"), second.cast("string"),
                    F.lit(r"}+)(.*)\z"))


def transform(docs: DataFrame, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """``docs`` with ``text`` (NULL as empty) and n, form, prefix_chars, middle_chars, output.

    ``rate`` percent of the texts are cut, ``spm_rate`` percent of those suffix first.  An empty text
    and one that holds a marker stay plain, so :func:`restore` is exact.  A NULL id counts as the
    empty string; rows with one id and text get one result, whatever their order; texts may be as
    long as Spark's strings; other columns pass through unless they bear a result's name, which is
    replaced; an empty table gives an empty one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    own = {"n", "form", "prefix_chars", "middle_chars", "output"}
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in own | {"text"}]
    h = seeds(F.col("doc_id"))
    counted = docs.select(*kept, text.alias("text"), F.regexp_count(text, F.lit(UNIT)).cast("long").alias("n"))
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    form = (F.when((F.col("text") == "") | marked | (h[2] % 100 >= rate), PLAIN)
            .when(h[3] % 100 < spm_rate, SPM).otherwise(PSM))
    cuts = [h[i] % (F.col("n") + 1) for i in (0, 1)]
    first, last = F.least(*cuts), F.greatest(*cuts)
    written = F.when(form == SPM, f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    output = F.when(form == PLAIN, F.col("text")).otherwise(
        F.regexp_replace("text", cut_pattern(first, last - first), written))
    done = counted.withColumns({"form": form, "output": output})
    return done.withColumns(dict(zip(("prefix_chars", "middle_chars"), part_chars(F.col("output"), F.col("form")))))


def part_chars(output: Column, form: Column) -> tuple[Column, Column]:
    """Code points of prefix and middle, read off the markers' places; NULL if plain."""
    at = {m: F.position(F.lit(m), output) for m in (PREFIX, SUFFIX, MIDDLE)}
    prefix_end = F.when(form == PSM, at[SUFFIX]).when(form == SPM, at[MIDDLE])
    width = len(PREFIX)
    return ((prefix_end - at[PREFIX] - width).cast("long"),
            F.when(form != PLAIN, F.char_length(output) - at[MIDDLE] - width + 1).cast("long"))


def restore(output: Column, form: Column) -> Column:
    """The text that :func:`transform` was given (NULL as empty), from its output and form alone."""
    psm = rf"(?s)\A{PREFIX}(.*){SUFFIX}(.*){MIDDLE}(.*)\z"
    spm = rf"(?s)\A{SUFFIX}(.*){PREFIX}(.*){MIDDLE}(.*)\z"
    return (F.when(form == PSM, F.regexp_replace(output, psm, "$1$3$2"))
            .when(form == SPM, F.regexp_replace(output, spm, "$2$3$1")).otherwise(output))


TRANSFORM_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS hex,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
seeded AS (
  SELECT doc_id, text, units, len(units)::BIGINT AS n,
         ('0x' || hex[1:8])::BIGINT AS h1, ('0x' || hex[9:16])::BIGINT AS h2,
         ('0x' || hex[17:24])::BIGINT AS h3, ('0x' || hex[25:32])::BIGINT AS h4
  FROM units),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM seeded),
parts AS (
  SELECT doc_id, n, form, text, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix
  FROM cut)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
