"""Fill-in-middle transformation: texts cut into prefix, middle and suffix, and put in another order.

A text is a row of units: a run of ASCII letters, or any other code point. ``regexp_count`` gives their
number n. Two numbers from a hash of the document's id say after how many units prefix and middle end,
and become the counted, possessive quantifiers of a pattern of that row's own, ``(unit{a}+)(unit{b-a}+)``
and the rest. One match thus captures all three parts, and its replacement puts them in order. A
possessive group is matched in a loop, without a stack, so very long texts are no matter; the count
holds the units of one text at a time. All of this is column expressions: rows are neither shuffled nor sent to Python.

A null text counts as an empty one, and an empty text stays plain. A null id is hashed as an empty one.
Equal rows come out equal. An empty table gives an empty one. Only the id and the results are returned,
so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "[A-Za-z]+|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_UNIT = "(?:[A-Za-z]++|[^A-Za-z])"


def quoted(name: str) -> Column:
    """A column by its very name, whatever dots or quotes are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def _numbers(doc_id: Column, seed: int) -> list[Column]:
    """The first four groups of eight hexadecimal digits of a hash of seed and id, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    seed: int = 1,
    plain_percent: int = 10,
    spm_percent: int = 20,
) -> DataFrame:
    """(doc_id, n, form, output, prefix_chars, middle_chars) for each row.

    ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain``: so many per
    cent of the texts stay as they are, and all that are empty or hold one of the marks. Of the others so
    many per cent are ``spm``. Lengths are in code points, and null where the form is plain.
    """
    h1, h2, h3, h4 = _numbers(F.col("doc_id"), seed)
    whole = docs.select(quoted(doc_id).alias("doc_id"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    rows = whole.select("doc_id", "text", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | marked | (h3 % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    ends = [h % (F.col("n") + 1) for h in (h1, h2)]
    rows = rows.select("*", form.alias("form"), F.least(*ends).alias("a"), F.greatest(*ends).alias("b"))
    pattern = F.concat(
        F.lit(rf"(?s)\A({_UNIT}{{"),
        F.col("a").cast("string"),
        F.lit(rf"}}+)({_UNIT}{{"),
        (F.col("b") - F.col("a")).cast("string"),
        F.lit(r"}+)(.*+)\z"),
    )
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    rows = rows.select("doc_id", "n", "form", output.alias("output"))
    at = {mark: F.locate(mark, "output") for mark in (PREFIX, SUFFIX, MIDDLE)}
    prefix = F.when(F.col("form") == "psm", at[SUFFIX] - 4).when(F.col("form") == "spm", at[MIDDLE] - at[PREFIX] - 3)
    middle = F.when(F.col("form") != "plain", F.length("output") - at[MIDDLE] - 2)
    return rows.select("*", prefix.cast("long").alias("prefix_chars"), middle.cast("long").alias("middle_chars"))


def restored(output: str | Column, form: str | Column) -> Column:
    """The text that an output was made from. No text with a mark in it is cut, so each mark occurs once."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    psm = F.regexp_replace(output, rf"(?s)\A{PREFIX}(.*){SUFFIX}(.*){MIDDLE}(.*)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{SUFFIX}(.*){PREFIX}(.*){MIDDLE}(.*)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
