"""Next-token tables and beam search as joins and windows."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from capstan.operators.ranking import global_rank
from capstan.session import Scratch, bucketed, stored

# Sequence marks, beam settings and the score unit. Log
# probabilities are kept as whole millionths, so sums and ties are exact.
START = "[CLS]"
END = "[SEP]"
NUM_BEAMS = 5
MAX_NEW_TOKENS = 16
NO_REPEAT_SIZE = 2
SCORE_UNIT = 1_000_000
# Fixed value: score of a pair of neighbours that a model has not seen, one in a million.
UNSEEN = -13_815_511
# Entries of a key's table that are searched in one row; keys of more go step by step.
ROW_ENTRIES = 50_000
# Successors of a token that are ranked in one task.
GROUP_ROWS = 1_000_000
# Different counts up to this one have different rounded scores: their logarithms differ by two units at least.
APART_COUNT = SCORE_UNIT // 2


def marked(tokens: Column | str) -> Column:
    """A caption's tokens between the start and the end mark."""
    return F.concat(F.array(F.lit(START)), tokens, F.array(F.lit(END)))


def neighbours(sequences: DataFrame, by: list[str], tokens: str) -> DataFrame:
    """(by, prev, next): every pair of neighbouring tokens."""
    size = F.greatest(F.size(tokens) - 1, F.lit(0))
    zipped = F.arrays_zip(
        F.slice(tokens, F.lit(1), size).alias("prev"), F.slice(tokens, F.lit(2), size).alias("next")
    )
    rows = sequences.select(*by, F.explode(zipped).alias("b"))
    return rows.select(*by, F.col("b.prev").alias("prev"), F.col("b.next").alias("next"))


def bigrams(sequences: DataFrame, by: list[str], tokens: str) -> DataFrame:
    """(by, prev, next, n): counts of neighbours, combined before the shuffle.

    Of a table by key the sequences move instead, each key's to one task: its
    pairs, many more bytes, are then counted and ranked where they are made.
    """
    if by:
        # As many parts as the session asks for: pairs take much more room than the sequences that adaptive merging sees.
        parts = int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        sequences = sequences.select(*by, tokens).repartition(parts, *by)
    rows = neighbours(sequences, by, tokens)
    return rows.groupBy(*by, "prev", "next").agg(F.count(F.lit(1)).alias("n"))


def score(count: Column, total: Column) -> Column:
    return F.round(F.log(count / total) * SCORE_UNIT).cast("long")


def token_scores(counts: DataFrame, by: list[str]) -> DataFrame:
    """(by, prev, next, n, logp) of every bigram.

    Tables that grow with the corpus are merge-joined, never broadcast on a
    guess of their size. The totals of a previous token are summed apart and joined back: partial
    sums collapse a frequent token before its shuffle. Within a key they are sums over a window.
    """
    if by:
        present = reduce(and_, [F.col(c).isNotNull() for c in (*by, "prev")])
        total = F.sum("n").over(Window.partitionBy(*by, "prev"))
        scored = counts.where(present).withColumn("total", total)
        return scored.select(*by, "prev", "next", "n", score(F.col("n"), F.col("total")).alias("logp"))
    totals = counts.groupBy(*by, "prev").agg(F.sum("n").alias("total"))
    joined = counts.join(totals.hint("merge"), [*by, "prev"])
    return joined.select(*by, "prev", "next", "n", score(F.col("n"), F.col("total")).alias("logp"))


def _common(counts: DataFrame) -> DataFrame:
    """(prev): tokens of more than ``GROUP_ROWS`` successors, or of such counts that two may have one score."""
    sizes = counts.groupBy("prev").agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("most"))
    return sizes.where((F.col("rows") > GROUP_ROWS) | (F.col("most") > APART_COUNT)).select("prev")


def _ranked_by_key(counts: DataFrame, by: list[str]) -> DataFrame:
    """(by, prev, next, logp, rank): successors ranked within their key and token."""
    order = Window.partitionBy(*by, "prev").orderBy(F.desc("logp"), F.asc("next"))
    return token_scores(counts, by).drop("n").withColumn("rank", F.row_number().over(order))


def _ranked_in_groups(counts: DataFrame) -> DataFrame:
    """(prev, next, logp, rank) of tokens that are not common, each ranked in one task.

    Their scores differ wherever their counts do, so one order serves total and rank.
    """
    group = Window.partitionBy("prev").orderBy(F.desc("n"), F.asc("next"))
    total = F.sum("n").over(group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ranked = counts.where(F.col("prev").isNotNull()).withColumn("total", total).withColumn("rank", F.row_number().over(group))
    return ranked.select("prev", "next", score(F.col("n"), F.col("total")).alias("logp"), "rank")


def _ranked_by_range(counts: DataFrame) -> DataFrame:
    """As :func:`_ranked_in_groups` without keys, by a range partitioning: a token may go over many tasks."""
    placed = global_rank(token_scores(counts, []).drop("n"), "prev", F.desc("logp"), F.asc("next"), name="__place")
    firsts = placed.groupBy("prev").agg(F.min("__place").alias("__first"))
    rank = (F.col("__place") - F.col("__first") + 1).cast("int")
    return placed.join(firsts.hint("merge"), "prev").select("prev", "next", "logp", rank.alias("rank"))


def next_tokens(counts: DataFrame, by: list[str], successors: int | None = None) -> DataFrame:
    """(by, prev, next, rank, logp): successors of each token, likeliest first, ties by token.

    All of them, or those up to rank ``successors``. The order is that of the
    search, by rounded score. Successors are ranked within their key and token;
    those of the common tokens of a whole table, which are no single group, by a
    range partitioning. Of common tokens there are few: each takes many rows or occurrences.
    """
    if by:
        ranked = _ranked_by_key(counts, by)
    else:
        counts = stored(counts, "counts")
        common = stored(_common(counts), "common")
        ranked = _ranked_in_groups(counts.join(F.broadcast(common), "prev", "left_anti"))
        if not common.isEmpty():
            often = _ranked_by_range(counts.join(F.broadcast(common), "prev", "left_semi"))
            ranked = ranked.unionByName(often)
    if successors is not None:
        ranked = ranked.where(F.col("rank") <= successors)
    return ranked.select(*by, "prev", "next", "rank", "logp")


def successor_lists(table: DataFrame, by: list[str]) -> DataFrame:
    """(by, prev, successors): one row per token, likeliest successor first."""
    entry = F.struct("rank", "next", "logp")
    return table.groupBy(*by, "prev").agg(F.sort_array(F.collect_list(entry)).alias("successors"))


def repeats_gram(seq: Column, candidate: Column, size: int) -> Column:
    """Whether ``candidate`` after ``seq`` would repeat a gram of ``size`` tokens; never for size 0."""
    if size <= 0:
        return F.lit(False)
    starts = F.sequence(F.lit(0), F.size(seq) - size)

    def same(i: Column) -> Column:
        equal = F.get(seq, i + (size - 1)) == candidate
        for k in range(size - 1):
            equal = equal & (F.get(seq, i + k) == F.get(seq, F.size(seq) - (size - 1) + k))
        return equal

    return F.when(F.size(seq) >= size, F.exists(starts, same)).otherwise(False)


def _by_table(
    live: DataFrame, lists: DataFrame, by: list[str], width: int, keys: list[str], no_repeat_size: int
) -> DataFrame:
    """Each beam beside its ``width`` best allowed successors in the lists of a table.

    Both sides grow with the corpus: a merge join, which spills.
    """
    allowed = F.filter("successors", lambda s: ~repeats_gram(F.col("seq"), s["next"], no_repeat_size))
    joined = live.withColumn("prev", F.element_at("seq", -1)).hint("merge").join(lists, [*keys, "prev"], "left")
    return joined.select(*by, "seq", "logp", "ends", F.slice(allowed, 1, width).alias("successors"))


def kept_beams(formed: DataFrame, by: list[str], num_beams: int, end: str | int = END) -> DataFrame:
    """Candidates of one step that stay: new live beams and new hypotheses.

    ``formed`` is (by, seq, logp, ends, successors): each beam with its best
    allowed successors (next, logp), at least 2 x ``num_beams`` of them where
    there are so many. A beam without one stops as it is.
    """
    width = 2 * num_beams
    formed = formed.select(*by, "seq", "logp", "ends", F.explode_outer("successors").alias("s"))
    stuck = F.col("s").isNull()
    formed = formed.select(
        *by,
        F.when(stuck, F.col("seq")).otherwise(F.concat("seq", F.array("s.next"))).alias("seq"),
        (F.col("logp") + F.coalesce("s.logp", F.lit(0))).alias("logp"),
        "ends",
        stuck.alias("stuck"),
        (~stuck & (F.col("s.next") == end)).alias("ended"),
    )
    group = Window.partitionBy(*by)
    order = group.orderBy("stuck", F.desc("logp"), F.asc("seq"))
    ranked = formed.withColumn("rank", F.row_number().over(order)).withColumn(
        "open_rank", F.sum((~F.col("ended") & ~F.col("stuck")).cast("int")).over(order)
    )
    ended = F.col("ended") & (F.col("rank") <= num_beams)
    opened = ~F.col("ended") & ~F.col("stuck") & (F.col("rank") <= width) & (F.col("open_rank") <= num_beams)
    counted = ranked.withColumn("ends", F.col("ends") + F.sum(ended.cast("int")).over(group))
    return counted.where(ended | opened | F.col("stuck")).select(
        *by, "seq", "logp", "ends", "stuck", "ended"
    )


def beam_step(
    live: DataFrame,
    lists: DataFrame,
    by: list[str],
    num_beams: int,
    table_by: list[str] | None = None,
    no_repeat_size: int = NO_REPEAT_SIZE,
) -> DataFrame:
    """One step over the lists of a table.

    ``live`` is (by, seq, logp, ends). Of each beam only its 2 x ``num_beams``
    best allowed successors can be among the 2 x ``num_beams`` best of its key,
    so no more are formed.
    """
    keys = by if table_by is None else table_by
    return kept_beams(_by_table(live, lists, by, 2 * num_beams, keys, no_repeat_size), by, num_beams)


def start_beams(work: Scratch, starts: DataFrame, by: list[str]) -> DataFrame:
    zero = F.lit(0).cast("long")
    return work.store(starts.select(*by, "seq", zero.alias("logp"), zero.alias("ends")), "live")


def search(
    work: Scratch,
    live: DataFrame,
    by: list[str],
    step: Callable[[DataFrame, int], DataFrame],
    num_beams: int,
    max_new_tokens: int,
) -> DataFrame:
    """(by, seq, score, length): the best hypothesis of each key.

    ``step`` makes the kept beams of a step from the live ones and the number of
    keys that still have some. Steps are written tables. A key stops once
    ``num_beams`` hypotheses have ended.
    """
    alive = live.select(*by).distinct().count()
    hypotheses = [live.limit(0).select("*", F.lit(False).alias("stuck"), F.lit(False).alias("ended"))]
    for _ in range(max_new_tokens):
        if not alive:
            break
        made = work.store(step(live, alive), "step")
        hypotheses.append(made.where(F.col("ended") | F.col("stuck")))
        live = made.where(~F.col("ended") & ~F.col("stuck") & (F.col("ends") < num_beams))
        live = live.select(*by, "seq", "logp", "ends")
        alive = live.select(*by).distinct().count()
    hypotheses.append(live.select("*", F.lit(False).alias("stuck"), F.lit(False).alias("ended")))
    every = hypotheses[0]
    for more in hypotheses[1:]:
        every = every.unionByName(more)
    length = F.size("seq") - F.col("ended").cast("int")
    cost = (-(F.col("logp") / SCORE_UNIT / length)).alias("cost")
    scored = every.select(*by, F.struct(cost, F.col("seq"), length.alias("length")).alias("h"))
    best = scored.groupBy(*by).agg(F.min("h").alias("h"))
    return stored(best.select(*by, "h.seq", (-F.col("h.cost")).alias("score"), "h.length"), "hypotheses")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _best_of_row(start: Column, table: Column, num_beams: int, max_new_tokens: int, no_repeat_size: int) -> Column:
    """The best hypothesis (cost, seq, length) of one key, all steps of its search in one expression.

    ``start`` is its first sequence, ``table`` a map from a token to its
    successors (next, logp). The rules are those of :func:`kept_beams`.
    """
    width = 2 * num_beams

    def hypothesis(beam: Column, ended: Column) -> Column:
        length = F.size(beam["seq"]) - ended.cast("int")
        return F.struct(
            (-(-beam["cost"] / SCORE_UNIT / length)).alias("cost"), beam["seq"].alias("seq"), length.alias("length")
        )

    def candidates(beam: Column) -> Column:
        def formed(allowed: Column) -> Column:
            def follow(s: Column) -> Column:
                return F.struct(
                    F.lit(False).alias("stuck"),
                    (beam["cost"] - s["logp"]).alias("cost"),
                    F.concat(beam["seq"], F.array(s["next"])).alias("seq"),
                    (s["next"] == END).alias("ended"),
                )

            stopped = F.struct(
                F.lit(True).alias("stuck"), beam["cost"].alias("cost"), beam["seq"].alias("seq"), F.lit(False).alias("ended")
            )
            return F.when(F.size(allowed) > 0, F.transform(allowed, follow)).otherwise(F.array(stopped))

        successors = F.coalesce(F.get(F.array(table[F.element_at(beam["seq"], -1)]), F.lit(0)), F.array())
        allowed = F.filter(successors, lambda s: ~repeats_gram(beam["seq"], s["next"], no_repeat_size))
        return _let(F.slice(allowed, 1, width), formed)

    def kept(state: Column, order: Column) -> Column:
        ended = F.filter(order, lambda c, i: c["ended"] & (i < num_beams))
        opened = F.slice(F.filter(order, lambda c, i: ~c["ended"] & ~c["stuck"] & (i < width)), 1, num_beams)
        beams = F.transform(opened, lambda c: F.struct(c["seq"].alias("seq"), c["cost"].alias("cost")))
        found = F.transform(F.concat(ended, F.filter(order, lambda c: c["stuck"])), lambda c: hypothesis(c, c["ended"]))
        ends = state["ends"] + F.size(ended)
        return F.struct(
            F.when(ends < num_beams, beams).otherwise(F.slice(beams, 1, 0)).alias("live"),
            ends.alias("ends"),
            F.array_min(F.concat(F.array(state["best"]), found)).alias("best"),
        )

    def step(state: Column, _: Column) -> Column:
        # Stuck beams come last; then by score, ties by sequence.
        order = F.array_sort(F.flatten(F.transform(state["live"], candidates)))
        return F.when(F.size(state["live"]) > 0, _let(order, lambda o: kept(state, o))).otherwise(state)

    def finish(state: Column) -> Column:
        rest = F.transform(state["live"], lambda b: hypothesis(b, F.lit(False)))
        return F.array_min(F.concat(F.array(state["best"]), rest))

    live = F.array(F.struct(start.alias("seq"), F.lit(0).cast("long").alias("cost")))
    none = F.array_min(F.slice(F.transform(live, lambda b: hypothesis(b, F.lit(False))), 1, 0))
    first = F.struct(live.alias("live"), F.lit(0).alias("ends"), none.alias("best"))
    return F.reduce(F.sequence(F.lit(1), F.lit(max_new_tokens)), first, step, finish)


def _search_by_row(
    lists: DataFrame, starts: DataFrame, by: list[str], num_beams: int, max_new_tokens: int, no_repeat_size: int
) -> DataFrame:
    """(by, seq, score, length, apart): the search of each key in its one row.

    Keys of more than ``ROW_ENTRIES`` entries, or of several starts, are ``apart``: their tables are not gathered.
    """
    entries = F.sum(F.size("successors")).over(Window.partitionBy(*by))
    sized = lists.withColumn("__n", entries)
    entry = F.struct("prev", F.transform("successors", lambda s: F.struct(s["next"].alias("next"), s["logp"].alias("logp"))))
    gathered = F.collect_list(F.when((F.col("__n") <= ROW_ENTRIES) & F.col("prev").isNotNull(), entry))
    tables = sized.groupBy(*by).agg(F.map_from_entries(gathered).alias("__table"), F.max("__n").alias("__n"))
    firsts = starts.groupBy(*by).agg(F.min("seq").alias("__start"), F.count(F.lit(1)).alias("__starts"))
    rows = firsts.join(tables.hint("merge"), by, "left")
    apart = (F.col("__starts") > 1) | F.coalesce(F.col("__n") > ROW_ENTRIES, F.lit(False))
    best = _best_of_row(F.col("__start"), F.col("__table"), num_beams, max_new_tokens, no_repeat_size)
    rows = rows.select(*by, F.when(~apart, best).alias("h"), apart.alias("apart"))
    return rows.select(*by, "h.seq", (-F.col("h.cost")).alias("score"), "h.length", "apart")


def beam_search(
    table: DataFrame,
    starts: DataFrame,
    by: list[str],
    num_beams: int = NUM_BEAMS,
    max_new_tokens: int = MAX_NEW_TOKENS,
    start_length: int = 1,
    table_by: list[str] | None = None,
    no_repeat_size: int = NO_REPEAT_SIZE,
    rows: int | None = None,
) -> DataFrame:
    """(by, seq, score, length): the best hypothesis of each key.

    ``table`` comes from :func:`next_tokens`, ``starts`` is (by, seq) with
    sequences of at most ``start_length`` tokens. ``table_by`` names the keys of
    the table: those of the beams by default, none for one table that all beams
    share. ``rows`` bounds the size of the table where it is known.

    No gram of ``no_repeat_size`` tokens is repeated and a key stops once
    ``num_beams`` hypotheses have ended. Only the best successors of a token are
    looked at: a step keeps 2 x ``num_beams`` of a beam, and a sequence has fewer
    than ``start_length + max_new_tokens`` grams, each of which forbids one.

    Where each key has a table of its own, of at most ``ROW_ENTRIES`` entries,
    its whole search is one row's: nothing moves between steps. All others go
    step by step, beams joined with tables.
    """
    keys = by if table_by is None else table_by
    needed = 2 * num_beams + start_length + max_new_tokens
    lists = successor_lists(table.where(F.col("rank") <= needed), keys)
    if list(keys) != list(by) or not by or max_new_tokens < 1:
        size = table.count() if rows is None else rows
        return _search_by_steps(lists, starts, by, keys, num_beams, max_new_tokens, no_repeat_size, size)
    found = stored(_search_by_row(lists, starts, by, num_beams, max_new_tokens, no_repeat_size), "hypotheses")
    best = found.where(~F.col("apart")).drop("apart")
    # Keys may be null among the starts.
    own = found.where("apart").select(*[F.col(c).alias(f"__{c}") for c in by])
    if own.isEmpty():
        return best
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by])
    lists, starts = (df.join(own.hint("merge"), same, "left_semi") for df in (lists, starts))
    size = lists.agg(F.sum(F.size("successors"))).first()[0] or 0
    return best.unionByName(_search_by_steps(lists, starts, by, by, num_beams, max_new_tokens, no_repeat_size, size))


def _search_by_steps(
    lists: DataFrame,
    starts: DataFrame,
    by: list[str],
    keys: list[str],
    num_beams: int,
    max_new_tokens: int,
    no_repeat_size: int,
    size: int,
) -> DataFrame:
    """:func:`beam_search` by a join of the live beams with the lists in each step.

    Tables by key are bucketed once, so that a step moves the live beams alone,
    and written anew whenever half the keys have ended. A shared table is
    shuffled with the beams, whose hot tokens adaptive execution then splits.
    """
    with Scratch(starts.sparkSession) as work, ExitStack() as copies:

        def placed(source: DataFrame, size: int) -> DataFrame:
            if not keys:
                return work.store(source, "successors")
            return copies.enter_context(bucketed(source, "successors", size, *keys, "prev"))

        live = start_beams(work, starts, by)
        lists = placed(lists, size)
        listed = live.select(*by).distinct().count() if keys else 0

        def step(live: DataFrame, alive: int) -> DataFrame:
            nonlocal lists, listed, size
            if keys and 2 * alive <= listed:
                size = -(-size * alive // listed)
                lists = placed(lists.join(live.select(*keys).distinct(), keys, "left_semi"), size)
                listed = alive
            return beam_step(live, lists, by, num_beams, keys, no_repeat_size)

        return search(work, live, by, step, num_beams, max_new_tokens)


def generated_text(seq: Column | str) -> Column:
    """Tokens of a hypothesis without its marks, joined by spaces."""
    return F.array_join(F.filter(seq, lambda t: ~t.isin(START, END)), " ")
