"""Lemmas of words a lexicon does not hold, by rules on endings learnt from the lexicon.

A pair of surface and lemma shows a rule: so many characters are cut off and an ending is put
on.  Every ending of the surface that holds what is cut is a node of a trie of endings, for the
word's class and for all classes, and a node keeps the rule that most words of it follow.  An
unknown word follows the rule of the longest ending known for its class, or else for all
classes; without any it is its own lemma.

Learning and applying are joins and aggregations on distinct words; a lexicon or a word list of
any size is fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.runtime import fits_broadcast, materialize

#: The class of rules that hold for words of any class.
ANY_TAG = ""

#: Largest table of rules, in bytes, that is sent to every executor.
RULES_BYTES = 32 * 1024 * 1024


def common_start(a: Column, b: Column) -> Column:
    """Number of characters that two strings begin with alike."""
    shorter = F.least(F.char_length(a), F.char_length(b))
    places = F.when(shorter > 0, F.sequence(F.lit(1), shorter))
    return F.coalesce(F.size(F.filter(places, lambda n: F.left(a, n) == F.left(b, n))), F.lit(0))


def _entries(lexicon: DataFrame) -> DataFrame:
    """Distinct ``word, lemma, tag`` of a lexicon in lower case; rows with nulls drop out."""
    columns = (F.lower("surface").alias("word"), F.lower("lemma").alias("lemma"), "tag")
    return lexicon.select(*columns).where("word <> '' and lemma <> '' and tag is not null").distinct()


def learn_rules(lexicon: DataFrame) -> DataFrame:
    """``tag, ending, cut, added`` from ``surface, lemma, tag``: a row per node of the trie.

    The rule of most words wins, then the one that cuts less, then the first by what it adds.
    Nodes of the same rule as the node above them are left out, as the longest match finds that.
    """
    kept = common_start(F.col("word"), F.col("lemma"))
    rules = _entries(lexicon).select(
        F.explode(F.array("tag", F.lit(ANY_TAG))).alias("tag"), "word", "lemma", kept.alias("kept")
    ).distinct()
    rules = rules.select(
        "tag", "word", (F.char_length("word") - F.col("kept")).alias("cut"), F.expr("substr(lemma, kept + 1)").alias("added")
    )
    lengths = F.explode(F.sequence(F.col("cut"), F.char_length("word"))).alias("length")
    nodes = rules.select("tag", "cut", "added", F.col("word").alias("whole"), lengths)
    counted = nodes.groupBy("tag", F.right("whole", F.col("length")).alias("ending"), "cut", "added").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("n"), "cut", "added")).alias("rule")
    best = materialize(counted.groupBy("tag", "ending").agg(first), "rules").select("tag", "ending", "rule.cut", "rule.added")
    above = best.select("tag", F.col("ending").alias("shorter"), F.struct("cut", "added").alias("above"))
    shorter = F.when(F.col("ending") != "", F.expr("substr(ending, 2)"))
    found = best.withColumn("shorter", shorter).join(above, ["tag", "shorter"], "left")
    found = found.where(~F.coalesce(F.struct("cut", "added") == F.col("above"), F.lit(False)))
    return materialize(found.select("tag", "ending", "cut", "added"), "lemma-rules")


def rule_lemmas(words: DataFrame, rules: DataFrame) -> DataFrame:
    """``word, tag, lemma`` of distinct lower-case ``word, tag`` rows by the longest ending.

    The endings of the words are many times the words, which Spark's guess of a size does not
    see, so the strategy is chosen here: rules of checked size are broadcast, more are joined by
    a shuffle, and the endings are never sent to the driver.
    """
    longest = rules.agg(F.max(F.char_length("ending"))).first()[0] or 0
    lengths = F.sequence(F.lit(0), F.least(F.char_length("word"), F.lit(longest)))
    tried = words.select("word", "tag", F.explode(lengths).alias("length")).withColumn("ending", F.right("word", F.col("length")))
    tried = tried.withColumn("sought", F.explode(F.array("tag", F.lit(ANY_TAG))))
    known = rules.select(F.col("tag").alias("sought"), "ending", "cut", "added")
    known = F.broadcast(known) if fits_broadcast(known, RULES_BYTES) else known.hint("merge")
    lemma = F.concat(F.expr("left(word, char_length(word) - cut)"), "added")
    found = tried.join(known, ["sought", "ending"], "left").withColumn("lemma", lemma)
    rank = F.when(F.col("lemma") != "", F.struct((F.col("sought") != ANY_TAG).alias("own"), "length"))
    best = found.groupBy("word", "tag").agg(F.max_by("lemma", rank).alias("lemma"))
    return best.select("word", "tag", F.coalesce("lemma", "word").alias("lemma"))


def lemmas(words: DataFrame, lexicon: DataFrame, rules: DataFrame) -> DataFrame:
    """``word, tag, lemma`` of distinct ``word, tag`` rows: from the lexicon, or else by rule.

    An entry of the word's class comes before those of other classes; of several the first
    lemma is taken.  A null class is any class.
    """
    rows = words.select(F.lower("word").alias("word"), "tag").distinct()
    entries = materialize(_entries(lexicon), "lexicon").select("word", "lemma", F.col("tag").alias("known"))
    own = F.coalesce(F.col("known") == F.col("tag"), F.lit(False))
    found = rows.join(entries, "word", "left").groupBy("word", "tag").agg(
        F.min(F.when(F.col("lemma").isNotNull(), F.struct((~own).alias("other"), "lemma")))["lemma"].alias("listed")
    )
    found = materialize(found, "listed")
    listed = found.where("listed is not null").select("word", "tag", F.col("listed").alias("lemma"))
    return listed.unionByName(rule_lemmas(found.where("listed is null"), rules))
