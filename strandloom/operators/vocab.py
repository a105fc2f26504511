"""Controlled vocabularies: standardizing values, candidate terms, decisions and what follows from them.

A vocabulary is a table (vocab_key, name, synonym, place): place is the order of listing, by which the first wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.expr import blank, row_fingerprint, trim_ws


def _lookups(vocab: DataFrame) -> DataFrame:
    """Every spelling with its rank: names before synonyms, exact before lower case, and in the order of listing; first wins."""
    forms = F.array(*[F.struct(F.lit(rank).alias("rank"), text.alias("text"), F.lit(folded).alias("folded")) for rank, text, folded in ((1, F.col("name"), False), (2, F.col("synonym"), False), (3, F.lower("name"), True), (4, F.lower("synonym"), True))])
    rows = vocab.select("vocab_key", "name", "place", F.inline(forms)).where(~blank("text"))
    return rows.groupBy("vocab_key", "text", "folded").agg(F.min(F.struct("rank", "place", "name")).alias("hit"))


def standardize(values: DataFrame, vocab: DataFrame, value: str = "value", key: str = "vocab_key") -> DataFrame:
    """Each distinct (key, value) with the matched name and the rule: canonical, synonym, case, trim or none.

    Distinct values meet the lookups once for each form (as is, lower case, trimmed lower case); blanks never match.
    """
    once = values.select(F.col(key).alias("vocab_key"), F.col(value).alias("input")).distinct()
    forms = F.array(F.struct(F.lit(0).alias("step"), F.col("input").alias("text"), F.lit(False).alias("folded")), F.struct(F.lit(1).alias("step"), F.lower("input").alias("text"), F.lit(True).alias("folded")), F.struct(F.lit(2).alias("step"), F.lower(trim_ws("input")).alias("text"), F.lit(True).alias("folded")))
    tried = once.where(~blank("input")).select("vocab_key", "input", F.inline(forms))
    hits = tried.join(_lookups(vocab), ["vocab_key", "text", "folded"]).groupBy("vocab_key", "input").agg(F.min(F.struct("step", "hit")).alias("best"))
    out = once.join(hits, ["vocab_key", "input"], "left")  # blanks, null ones too, have no hit
    rule = F.when(F.col("best").isNull(), "none").when(F.col("best.step") == 2, "trim").when(F.col("best.step") == 1, "case").when(F.col("best.hit.rank") == 1, "canonical").otherwise("synonym")
    return out.select("vocab_key", "input", F.coalesce("best.hit.name", "input").alias("value"), F.col("best").isNotNull().alias("matched"), rule.alias("rule"))


def unmatched(values: DataFrame, vocab: DataFrame) -> DataFrame:
    """One row for each distinct value without a match that isn't blank."""
    return standardize(values, vocab).where(~F.col("matched") & ~blank("input")).select("vocab_key", F.col("input").alias("value"))


def overlay(vocab: DataFrame, decisions: DataFrame) -> DataFrame:
    """The vocabulary with decisions in: their synonyms replace pinned rows of the same synonym; a decomposing new term adds none."""
    new = decisions.where((F.col("decision") == "synonym") | ((F.col("decision") == "new_term") & blank("also_field")))
    rows = new.select("vocab_key", F.col("target").alias("name"), F.col("value").alias("synonym"))
    kept = vocab.select("vocab_key", "name", "synonym").join(rows.select("vocab_key", "synonym").distinct(), ["vocab_key", "synonym"], "left_anti")
    return kept.select("vocab_key", "name", "synonym").union(rows.distinct())


def remap(decisions: DataFrame) -> DataFrame:
    """Rewrites of one value into a value and a second field's value."""
    picked = decisions.where((F.col("decision") == "decompose") | ((F.col("decision") == "new_term") & ~blank("target") & ~blank("also_field")))
    return picked.select("vocab_key", "value", "target", "also_field", "also_value")


def apply_remap(rows: DataFrame, table: DataFrame, primary: str, second: str) -> DataFrame:
    """rows with the primary column rewritten, and the second filled where it is blank."""
    wide = table.where(F.col("also_field") == second).groupBy(F.col("value").alias(primary)).agg(F.min(F.struct("target", "also_value")).alias("m"))
    joined = rows.join(wide, primary, "left")
    changed = {primary: F.coalesce("m.target", primary), second: F.coalesce(F.when(~blank(second), F.col(second)), F.col("m.also_value"), F.col(second))}
    return joined.withColumns(changed).drop("m").select(*rows.columns)


# Names in vocabularies that stand for no term.
PLACEHOLDERS = ("deleteMe", "needsToBeChanged", "deleteThisColumn", "changeMe", "TBD", "unknown")


def distance_score(value, term):
    """Edit distance by the longer length, less where one holds the other or they share a word's stem; small is close."""
    a, b = F.lower(value), F.lower(term)
    far = F.levenshtein(a, b) / F.greatest(F.length(value), F.length(term))
    inside = a.contains(b) | b.contains(F.substring(a, 1, 40))
    words = F.filter(F.split(a, "[^a-z0-9]+"), lambda w: F.length(w) >= 4)
    stem = F.exists(words, lambda w: b.startswith(w) | w.startswith(F.substring(b, 1, 5)))
    return far - F.when(inside, 0.6).otherwise(0.0) - F.when(stem, 0.25).otherwise(0.0)


def candidates(values: DataFrame, vocab: DataFrame, n: int = 5) -> DataFrame:
    """The names of the terms closest to each distinct value of a key: of the 3 n best spellings, names and synonyms alike, the first n names.

    Placeholders are no answer, nor are synonyms of them. Values meet the terms of their own key only: the equality on
    vocab_key makes it a hash join, vocabularies are small and values distinct unmatched ones. Ties go by listing.
    """
    forms = F.array(*[F.struct(F.lit(rank).alias("rank"), F.col(c).alias("term")) for rank, c in ((1, "name"), (2, "synonym"))])
    spelled = vocab.select("vocab_key", "name", "place", F.inline(forms)).where(F.col("term").isNotNull() & ~F.col("term").isin(*PLACEHOLDERS))
    terms = spelled.groupBy("vocab_key", "term").agg(F.min(F.struct("rank", "place", "name")).alias("at"))
    scored = values.select("vocab_key", "value").distinct().join(terms, "vocab_key").withColumn("score", distance_score(F.col("value"), F.col("term")))
    of_value = Window.partitionBy("vocab_key", "value")
    best = scored.withColumn("_r", F.row_number().over(of_value.orderBy("score", "at.rank", "at.place"))).where(F.col("_r") <= 3 * n)
    names = best.where(~F.col("at.name").isin(*PLACEHOLDERS)).groupBy("vocab_key", "value", F.col("at.name").alias("name")).agg(F.min(F.struct("_r", "score")).alias("b"))
    placed = names.withColumn("place", F.row_number().over(of_value.orderBy("b._r")).cast("long"))
    return placed.where(F.col("place") <= n).select("vocab_key", "value", "name", F.col("b.score").alias("score"), "place")


def thesaurus_match(values: DataFrame, concepts: DataFrame, n: int = 3, weak: float = 0.45) -> DataFrame:
    """Of each value's n closest concepts those that match at all: exact, altLabel, contains (either way) or similar. concepts: vocab_key, id, label, alt (array).

    Only concepts of the value's key are tried. A label inside a value counts from four characters in more than five.
    """
    a, b = F.lower(trim_ws("value")), F.lower("label")
    alts = F.transform(F.coalesce("alt", F.expr("cast(array() as array<string>)")), F.lower)
    far = F.levenshtein(a, b) / F.greatest(F.length(b), F.length(a))
    tests = {"exact": a == b, "in_alt": F.array_contains(alts, a), "holds": b.contains(a) | F.exists(alts, lambda x: x.contains(a)), "held": (F.length(a) > 5) & (F.length(b) > 3) & a.contains(b)}
    met = values.select("vocab_key", "value").where(~blank("value")).distinct().join(concepts, "vocab_key").withColumns({"far": far, **{k: F.coalesce(t, F.lit(False)) for k, t in tests.items()}})
    gain = sum((F.when(F.col(k), w).otherwise(0.0) for k, w in (("exact", 10.0), ("in_alt", 8.0), ("holds", 1.2), ("held", 0.8))), F.lit(0.0))
    w = Window.partitionBy("vocab_key", "value").orderBy("score", "id")
    best = met.withColumn("score", F.col("far") - gain).withColumn("place", F.row_number().over(w).cast("long")).where(F.col("place") <= n)
    rule = F.when(F.col("exact"), "exact").when(F.col("in_alt"), "altLabel").when(F.col("holds") | F.col("held"), "contains").otherwise("similar")
    return best.where(F.col("exact") | F.col("in_alt") | F.col("holds") | F.col("held") | (F.col("far") <= weak)).select("vocab_key", "value", "id", "label", rule.alias("rule"), "score", "place")


def review_queue(found: DataFrame, decided: DataFrame) -> DataFrame:
    """Unknown values by count, with their datasets and an example, but for decided ones. found: vocab_key, value, dataset_id, tsid."""
    left = found.join(decided.select("vocab_key", "value").distinct(), ["vocab_key", "value"], "left_anti")
    return left.groupBy("vocab_key", "value").agg(F.count("*").alias("n"), F.min("tsid").alias("example"), F.array_join(F.array_sort(F.collect_set("dataset_id")), ",").alias("datasets"))


CONFIDENCE = {"low": 1, "medium": 2, "high": 3}


def accept(items: DataFrame, least: str = "high") -> DataFrame:
    """Undecided items take their proposal where its confidence is high enough; a missing confidence is low."""
    rank = F.when(F.col("confidence") == "high", 3).when(F.col("confidence") == "medium", 2).otherwise(1)
    take = F.col("decision").isNull() & F.col("proposed").isNotNull() & (rank >= CONFIDENCE[least])
    return items.withColumns({"decision": F.when(take, F.col("proposed")).otherwise(F.col("decision")), "target": F.when(take, F.col("proposed_target")).otherwise(F.col("target")), "accepted": take})


def review_violations(items: DataFrame, vocab: DataFrame) -> DataFrame:
    """Decided items that can't be applied: (rule, vocab_key, value)."""
    names = vocab.select("vocab_key", F.col("name").alias("target"), F.lit(True).alias("is_name")).distinct()
    twice = items.where("decision is not null").groupBy("vocab_key", "value").agg(F.count("*").alias("n"))
    joined = items.where("decision is not null").join(names, ["vocab_key", "target"], "left").join(twice, ["vocab_key", "value"])
    tests = {
        "unknown_decision": ~F.col("decision").isin("synonym", "new_term", "decompose", "ignore"),
        "synonym_target": (F.col("decision") == "synonym") & F.col("is_name").isNull(),
        "new_term_exists": (F.col("decision") == "new_term") & F.col("is_name").isNotNull(),
        "decompose_incomplete": (F.col("decision") == "decompose") & (blank("also_field") | blank("also_value")),
        "decided_twice": F.col("n") > 1,
    }
    found = F.filter(F.array(*[F.when(t, F.lit(r)) for r, t in tests.items()]), lambda x: x.isNotNull())
    return joined.select(F.explode(found).alias("rule"), "vocab_key", "value")


def patches(decisions: DataFrame, vocab: DataFrame) -> DataFrame:
    """Distinct rows that decisions add to the vocabulary and it doesn't have, nulls being equal."""
    rows = decisions.where(F.col("decision").isin("synonym", "new_term")).select("vocab_key", F.col("target").alias("name"), F.when(F.col("decision") == "synonym", F.col("value")).alias("synonym")).distinct()
    have = vocab.select("vocab_key", "name", "synonym")
    same = [rows[c].eqNullSafe(have[c]) for c in ("vocab_key", "name", "synonym")]
    return rows.join(have, same[0] & same[1] & same[2], "left_anti")


def review_groups(items: DataFrame) -> DataFrame:
    """Items that share decision, target and field, largest group first."""
    return items.groupBy("decision", "target", "vocab_key").agg(F.count("*").alias("n"), F.min("value").alias("first_value"))


def pin(vocab: DataFrame) -> DataFrame:
    """One row for the vocabulary's contents by key."""
    return vocab.groupBy("vocab_key").agg(row_fingerprint("name", "synonym").alias("pin"))
