"""Quality rules by weak supervision, in DataFrame and SQL functions only.

Each rule looks at a few counts of a text and votes good (1), bad (-1) or
abstains (0).  Expectation-maximisation estimates, from how the votes of all
documents agree, how often each rule votes each way on good and on bad
documents, and the posterior probability of being good replaces "must pass
every rule".  A bad vote of a rule that others seldom bear out does not decide
alone; one of a rule that they mostly bear out may.  A good vote never counts
against a document, a bad one never for it, and a rule that abstains says
nothing in the verdict: no bad vote, no rejection while most documents are good.

The rules' votes have at most ``3 ** len(RULES)`` patterns, so the data that
EM works on is a count per pattern: bounded by the rules, whatever the number
of documents.  All of EM is one SQL expression over that one row.

Letters are letters and the marks that combine with them (vowel signs of Indic
scripts).  Variety is counted in stretches of ``STRETCH`` words, so it does not
fall with the length of a text.

Defined results: a null text counts as empty; a text without words has counts
of 0 and fails the base; null, repeated or missing ids play no part (each row
is judged by its own text); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.scratch import column_of, positional, words_of, written

WINDOW = 8           # words in a window whose repetition counts
STRETCH = 1000       # words among which distinct ones are counted
MIN_WORDS = 20       # base: fewer words fail
MAX_REPEAT_PCT = 30  # base: a larger share of repeated words fails
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rule name -> (bad when, good when) over the counts; neither: abstains.
RULES = {
    "symbols": ("n_symbols > 0.08 * word_chars", "n_symbols <= 0.03 * word_chars"),
    "letters": ("n_letters < 0.78 * word_chars", "n_letters >= 0.88 * word_chars"),
    "repeats": ("n_repeat_words > 0.25 * n_words", "n_repeat_words <= 0.05 * n_words"),
    "lines": ("n_dup_lines >= 3 AND n_dup_lines > 0.30 * n_lines", "n_dup_lines <= 0.05 * n_lines"),
    "capitals": ("n_capitals > 0.40 * word_chars", "n_capitals <= 0.15 * word_chars"),
    "stress": ("n_stress > 0.15 * n_words", "n_stress <= 0.03 * n_words"),
    "variety": ("n_stretch_words < 0.15 * n_words", "n_stretch_words >= 0.30 * n_words"),
    "length": ("n_words < 10", "n_words >= 60"),
}

#: What EM is pulled towards: (good, abstain, bad) votes on good and on bad
#: documents, each worth this number of documents whatever the corpus, so that
#: data outweigh it.  A bad document mostly breaks a rule or two and satisfies
#: the others, so a good vote says little and a bad one much.
PRIOR = {"good": (0.930, 0.068, 0.002), "bad": (0.75, 0.05, 0.20)}
PRIOR_DOCUMENTS = 10
ITERATIONS = 20


def text_counts(df: DataFrame, text: str) -> DataFrame:
    """``df`` plus the counts that base and rules use.  Everything is worked
    out within the row: nothing is shuffled."""
    t = F.coalesce(F.col(text), F.lit(""))
    no_symbols = F.translate(t, SYMBOLS, "")
    lines = F.filter(F.split(t, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    a = df.withColumns({"_w": words_of(F.col(text)), "_lines": lines,
                        "n_symbols": (F.length(t) - F.length(no_symbols)).cast("long"),
                        "n_capitals": (F.length(t) - F.length(F.translate(t, CAPITALS, ""))).cast("long"),
                        "n_letters": F.length(F.regexp_replace(t, r"[^\p{L}\p{M}]+", "")).cast("long"),
                        "n_stress": (F.length(t) - F.length(F.translate(t, "!", ""))).cast("long"),
                        "word_chars": F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long")})
    n = F.size("_w")
    b = a.withColumns({
        "n_words": n.cast("long"),
        # distinct words of each stretch, added up over the whole text: the share
        # of a book is the mean of its stretches' shares, not less for its length
        "n_stretch_words": F.expr(f"""CASE WHEN size(_w) <= {STRETCH} THEN CAST(size(array_distinct(_w)) AS BIGINT) ELSE
            aggregate(sequence(1, size(_w), {STRETCH}), 0L, (s, i) -> s + size(array_distinct(slice(_w, i, {STRETCH})))) END"""),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_h": F.when(n >= WINDOW, F.expr(
            f"transform(sequence(1, size(_w) - {WINDOW - 1}), i -> xxhash64(slice(_w, i, {WINDOW})))")),
    }).drop("_w", "_lines")
    # only texts with a repeated window go on: sort (hash, start), keep starts
    # whose neighbour has the same hash, and add up what each one covers
    c = b.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"),
                                  F.expr("sort_array(transform(_h, (x, i) -> struct(x AS h, i AS i)))"))).drop("_h")
    d = c.withColumn("_p", F.expr("""
        array_sort(array_distinct(flatten(transform(
            filter(zip_with(_s, slice(_s, 2, size(_s)), (a, b) -> struct(a, b)), x -> x.a.h = x.b.h),
            x -> array(x.a.i, x.b.i)))))""")).drop("_s")
    covered = f"zip_with(_p, slice(_p, 2, size(_p)), (a, b) -> least({WINDOW}, coalesce(b - a, {WINDOW})))"
    return d.withColumn("n_repeat_words", F.expr(
        f"coalesce(aggregate({covered}, 0L, (s, x) -> s + x), 0L)")).drop("_p")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def _votes() -> Column:
    return F.array(*[F.expr(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END")
                     for bad, good in RULES.values()])


def _em(patterns: DataFrame) -> DataFrame:
    """(votes, n) per pattern -> (votes, posterior).

    State: the probability of being good for each pattern.  One step estimates
    the votes' rates from the state (M) and the state from the rates (E); the
    verdict is a last E without the abstentions."""
    m = len(RULES)
    good = f"array({', '.join(map(str, PRIOR['good']))})"
    bad = f"array({', '.join(map(str, PRIOR['bad']))})"
    rows = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("p"))

    def mass(weight: str, when: str = "true") -> str:
        return (f"aggregate(zip_with(p, q, (x, w) -> IF({when}, x.n * {weight}, 0D)), 0D,"
                " (s, v) -> s + v)")

    strength = f"{float(PRIOR_DOCUMENTS)}D"
    same = "element_at(x.votes, j) = v"
    # rates: for rule j and vote v the log ratio of its rates on good and bad
    ratio = (f"ln(({mass('w', same)} + {strength} * element_at({good}, 2 - v)) / ({mass('w')} + {strength}))"
             f" - ln(({mass('(1 - w)', same)} + {strength} * element_at({bad}, 2 - v))"
             f" / ({mass('(1 - w)')} + {strength}))")
    # a good vote is no evidence of bad, a bad one none of good, and to abstain is in between
    ordered = "array(greatest(r[0], 0D), least(greatest(r[1], least(r[2], 0D)), greatest(r[0], 0D)), least(r[2], 0D))"
    model = (f"struct(ln(({mass('w')} + {strength}) / ({mass('(1 - w)')} + {strength})) AS odds,"
             f" transform(transform(sequence(1, {m}), j -> transform(array(1, 0, -1), v -> {ratio})), r -> {ordered}) AS r)")

    def posterior(of_vote: str) -> str:
        votes = f"aggregate(zip_with(x.votes, m.r, (v, r) -> {of_vote}), m.odds, (s, v) -> s + v)"
        return f"element_at(transform(array({model}), m -> transform(p, x -> 1 / (1 + exp(-({votes}))))), 1)"

    step, verdict = posterior("element_at(r, 2 - v)"), posterior("IF(v = 0, 0D, element_at(r, 2 - v))")
    start = ("transform(p, x -> aggregate(x.votes, 1D, (s, v) -> s + IF(v = 1, 1, 0))"
             " / aggregate(x.votes, 2D, (s, v) -> s + CASE v WHEN 1 THEN 1 WHEN -1 THEN 4 ELSE 0 END))")
    fitted = rows.select("p", F.expr(
        f"aggregate(sequence(1, {ITERATIONS}), {start}, (q, i) -> {step})").alias("q"))
    judged = fitted.select("p", F.expr(verdict).alias("q"))
    return judged.select(F.explode(F.arrays_zip("p", "q")).alias("z")).select(
        F.col("z.p.votes").alias("votes"), F.col("z.q").alias("posterior"))


def quality_rules(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Judge every row of ``docs``.  The result has the columns ``carry`` (all
    by default), by position as ``_in0 ...`` of :func:`scratch.positional`, and
    the counts, ``votes``, ``posterior``, ``base_failed`` and ``kept``."""
    pos, names = positional(docs)
    keep = [column_of(names, c) for c in carry] if carry is not None else pos.columns
    counted = text_counts(pos, column_of(names, text))
    counts = [c for c in counted.columns if not c.startswith("_in")]
    counted = written(counted.select(*keep, *counts).withColumn("votes", _votes()), "quality")
    posterior = _em(counted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")))
    # at most 3 ** len(RULES) patterns: a proven bound for the broadcast
    judged = counted.join(F.broadcast(posterior), "votes", "left")
    return judged.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))


def keep_documents(docs: DataFrame) -> DataFrame:
    """Pipeline form: the documents that are kept, columns as they came."""
    judged = quality_rules(docs)
    return judged.filter("kept").select(*[f"_in{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)
