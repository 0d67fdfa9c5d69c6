"""Names canonicalised by a table of rules that grows with the data.

``names.canonicalize`` folds a few rules into one expression; thousands of rules
would be tested against every name there.  Here the rules are rows ``(pattern,
canonical, priority)``.  Each alternative of a pattern is filed under one piece
of text that any name it matches must hold, and a name is tested only against
the rules that are filed under a piece of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Patterns that can be filed: alternatives in brackets or not, of plain characters, perhaps anchored.
_PLAIN = r"^\(?\^?[A-Za-z0-9 '&_-]+\$?\)?$"
_GRAM = 3
#: What may stand behind a word: a space, or the line end that ``$`` allows before it.
_ENDS = r"[ \n\r\x{85}\x{2028}\x{2029}]"


def _pieces(text: Column) -> Column:
    """What a name holds: its words between spaces and its runs of three characters, each marked by its kind."""
    words = F.transform(F.split(text, _ENDS), lambda w: F.concat(F.lit("w:"), w))
    grams = F.when(F.length(text) >= _GRAM, F.transform(
        F.sequence(F.lit(1), F.length(text) - _GRAM + 1), lambda i: F.concat(F.lit("g:"), F.substring(text, i, F.lit(_GRAM)))))
    return F.array_distinct(F.concat(words, F.coalesce(grams, F.array().cast("array<string>"))))


def _needed(alternative: Column) -> Column:
    """Pieces that every name holds which a plain alternative is found in.

    A word counts only where both of its ends are known: a space or an anchor.
    """
    bare = F.regexp_replace(alternative, r"^\(|\)$", "")
    literal = F.regexp_replace(bare, r"^\^|\$$", "")
    # Words at the rim of the text go on in the name, unless the pattern is anchored there.
    inner = F.regexp_replace(F.regexp_replace(bare, r"^[^\^ ][^ ]*", "#"), r"[^\$ ]*[^\$ ]$", "#")
    words = F.filter(F.split(F.regexp_replace(inner, r"^\^|\$$", ""), " "), lambda w: (w != "") & (w != "#"))
    grams = F.filter(_pieces(literal), lambda p: p.startswith("g:"))
    return F.concat(F.transform(words, lambda w: F.concat(F.lit("w:"), w)), grams)


def rule_index(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(filed, unfiled): rules by the rarest piece that each of their alternatives needs, and rules with an
    alternative that needs none that is known (short or no plain text), which any name must be tested against."""
    numbered = rules.select("pattern", "canonical", "priority")
    parts = numbered.withColumn("_alternatives", F.split("pattern", r"\|"))
    plain = F.forall("_alternatives", lambda a: a.rlike(_PLAIN) & (F.size(_needed(a)) > 0))
    told = parts.withColumn("_plain", F.coalesce(plain, F.lit(False)))
    pieces = told.where("_plain").select("pattern", "canonical", "priority", F.posexplode("_alternatives").alias("_n", "_a")).select(
        "pattern", "canonical", "priority", "_n", F.explode(_needed(F.col("_a"))).alias("piece"))
    shared = pieces.groupBy("piece").agg(F.count("*").alias("_rules"))
    filed = pieces.join(shared, "piece").groupBy("pattern", "canonical", "priority", "_n").agg(
        F.min(F.struct("_rules", "piece")).alias("_best")).select("pattern", "canonical", "priority", F.col("_best.piece").alias("piece"))
    return filed.distinct(), told.where("not _plain").select("pattern", "canonical", "priority")


def canonicalize_by_table(df: DataFrame, name_col: str, rules: DataFrame, out_col: str | None = None,
                          max_unfiled: int = 200) -> DataFrame:
    """``df`` with ``out_col`` (default: ``name_col``) by the first rule, in order of ``priority``, that is found in the name.

    No rule leaves the name as it is, null stays null; of rules of equal priority the smaller canonical name wins.
    Each distinct name is looked up once; a name meets the rules filed under its pieces in an equi-join, and only
    those are tested.  Rules that can't be filed are few and tested in the names' rows; more than ``max_unfiled`` are
    an error, since every name would be tested against all of them.
    """
    out_col = out_col or name_col
    filed, unfiled = rule_index(rules)
    always = unfiled.orderBy("priority", "canonical").limit(max_unfiled + 1).collect()
    if len(always) > max_unfiled:
        raise ValueError(f"more than {max_unfiled} rules have no plain text of {_GRAM} characters to be filed under")
    names = df.select(F.col(name_col).alias("_name")).where("_name is not null").distinct()
    met = names.select("_name", F.explode(_pieces(F.col("_name"))).alias("piece")).join(filed, "piece")
    found = met.where("_name rlike pattern").groupBy("_name").agg(F.min(F.struct("priority", "canonical")).alias("_hit"))
    kind = rules.schema["priority"].dataType.simpleString()
    own = F.lit(None).cast(f"struct<priority: {kind}, canonical: string>")
    if always:  # in order, so the first that is found is the least
        tested = [F.when(F.col("_name").rlike(r["pattern"]), F.struct(
            F.lit(r["priority"]).cast(kind).alias("priority"), F.lit(r["canonical"]).alias("canonical"))) for r in always]
        own = F.coalesce(*tested)
    told = names.join(found, "_name", "left").select("_name", F.least("_hit", own)["canonical"].alias("_canonical"))
    told = told.where("_canonical is not null")
    keep = [c for c in df.columns if c != out_col]
    return df.join(told, df[name_col] == told["_name"], "left").select(
        *(df[c] for c in keep), F.coalesce("_canonical", df[name_col]).alias(out_col))


def apply_alias_table(df: DataFrame, name_col: str, aliases: DataFrame, out_col: str | None = None) -> DataFrame:
    """``df`` with names replaced that ``aliases (alias, canonical)`` lists; others and nulls stay.

    A plain equi-join: the planner broadcasts the aliases only where their size allows it.  An alias that is listed
    twice takes the smaller canonical name.
    """
    out_col = out_col or name_col
    one = aliases.groupBy(F.col("alias").alias("_alias")).agg(F.min("canonical").alias("_canonical"))
    keep = [c for c in df.columns if c != out_col]
    return df.join(one, df[name_col] == one["_alias"], "left").select(
        *(df[c] for c in keep), F.coalesce("_canonical", df[name_col]).alias(out_col))
