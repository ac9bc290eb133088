"""Fill-in-the-middle rewriting of whole texts by one regular-expression match per row.

A text is a run of units: a word with the blanks before it, or blanks at the end.  ``regexp_count`` gives their number n.  The two
cut points come from a hash of the row's id, and become counted possessive groups of a pattern made for the row,
``(unit{a})(unit{b-a})(rest)``.  One match captures prefix, middle and suffix, and its replacement puts them in the order of
the row's form.  Possessive repeats never step back, so the match is linear in the text and needs no stack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.llm.common import packed, unpacked

UNIT = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"
MARKERS = ("<P>", "<S>", "<M>")


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, suffix_first: int = 80) -> DataFrame:
    """``docs`` with ``_fim``: n, form, prefix_chars, middle_chars, output.

    ``percent`` of the rows are rewritten, ``suffix_first`` of these as ``<S>suffix<P>prefix<M>middle`` (form spm), the others as
    ``<P>prefix<S>suffix<M>middle`` (psm).  All other rows, empty texts and texts that hold one of the markers are
    plain: the output is the text, and the lengths (in code points) are null.  A null text is an empty one; a null id draws as
    an empty id.  Prefix, middle and suffix may be empty.  Rows with the same id and text get the same output.  Other columns
    pass through whatever their names, but for a former ``_fim``, which is replaced; an empty table gives no rows.
    """
    h1, h2, h3, h4 = _draws(F.col("doc_id"), seed)
    text, unit = F.col("_t"), F.lit(UNIT)
    rows = packed(docs).withColumn("_t", F.coalesce("text", F.lit(""))).withColumn("_n", F.regexp_count(text, unit).cast("bigint"))
    marked = F.lit(False)
    for marker in MARKERS:
        marked = marked | F.contains(text, F.lit(marker))
    form = F.when((text == "") | marked | (h3 % 100 >= percent), "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    one, two = h1 % (F.col("_n") + 1), h2 % (F.col("_n") + 1)
    cut = rows.select("*", form.alias("_form"), F.least(one, two).alias("_a"), F.greatest(one, two).alias("_b"))
    counted = [F.concat(F.lit(f"((?:{UNIT}){{"), count.cast("string"), F.lit("}+)")) for count in (F.col("_a"), F.col("_b") - F.col("_a"))]
    pattern = F.concat(F.lit(r"\A"), *counted, F.lit(r"((?s:.*+))\z"))
    order = F.when(F.col("_form") == "psm", "<P>$1<S>$3<M>$2").otherwise("<S>$3<P>$1<M>$2")
    output = F.when(F.col("_form") == "plain", text).otherwise(F.regexp_replace(text, pattern, order))
    done = cut.withColumn("_output", output)
    after_prefix = F.when(F.col("_form") == "psm", F.instr("_output", "<S>")).otherwise(F.instr("_output", "<M>"))
    before_prefix = F.when(F.col("_form") == "psm", F.lit(1)).otherwise(F.instr("_output", "<P>"))
    lengths = {
        "prefix_chars": after_prefix - before_prefix - 3,
        "middle_chars": F.char_length("_output") - F.instr("_output", "<M>") - 2,
    }
    fim = F.struct(
        F.col("_n").alias("n"),
        F.col("_form").alias("form"),
        *[F.when(F.col("_form") != "plain", c).cast("bigint").alias(name) for name, c in lengths.items()],
        F.col("_output").alias("output"),
    )
    return done.select(*unpacked([c for c in docs.columns if c != "_fim"]), fim.alias("_fim"))


def restored(output: Column, form: Column) -> Column:
    """The text that was cut, from an output and its form alone."""
    parts = F.split(output, "<[PSM]>", -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
