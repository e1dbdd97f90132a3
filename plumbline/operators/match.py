"""Text joins and key repair."""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher
from functools import reduce
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import constants as K
from plumbline.functions.classify import confidence_tier
from plumbline.session import reliable_checkpoint

from .scale import join_null_safe, share, spread, top_per_key

# ---------------------------------------------------------------- containment join


def _grams(text: Column, size: Column) -> Column:
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, size)))


def contained_in(short: DataFrame, long: DataFrame) -> DataFrame:
    """Pairs (short, long) of distinct texts where the first lies inside the second, exactly.

    A text can only lie inside another that has all of its three-letter pieces, so the pairs come
    from an equi-join on the rarest piece of the short text instead of a comparison of all pairs.
    Both inputs have one text column, named ``short`` and ``long``.
    """
    texts = spread(long.where(F.length("long") > 0).distinct())
    sizes = F.sequence(F.lit(1), F.least(F.lit(3), F.length("long")))
    pieces = texts.select("long", F.explode(F.flatten(F.transform(sizes, lambda n: _grams(F.col("long"), n)))).alias("piece"))
    frequency = pieces.groupBy("piece").agg(F.count("*").alias("n_texts"))
    wanted = short.where(F.length("short") > 0).distinct()
    wanted = wanted.withColumn("_pieces", _grams(F.col("short"), F.least(F.lit(3), F.length("short"))))
    exploded = wanted.select("short", F.size("_pieces").alias("n"), F.explode("_pieces").alias("piece"))
    rarest = (
        exploded.join(frequency, "piece")
        .groupBy("short", "n").agg(F.min(F.struct("n_texts", "piece")).alias("r"), F.count("*").alias("found"))
        .where(F.col("found") == F.col("n"))
        .select("short", F.col("r.piece").alias("piece"))
    )
    return rarest.join(pieces, "piece").where(F.col("long").contains(F.col("short"))).select("short", "long")


def names_either_way(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (left_name, right_name) where either contains the other, ignoring case."""
    a = left.select(F.col("left_name"), F.lower("left_name").alias("l")).distinct()
    b = right.select(F.col("right_name"), F.lower("right_name").alias("r")).distinct()
    inside = contained_in(a.select(F.col("l").alias("short")), b.select(F.col("r").alias("long")))
    around = contained_in(b.select(F.col("r").alias("short")), a.select(F.col("l").alias("long")))
    pairs = inside.select(F.col("short").alias("l"), F.col("long").alias("r")).union(
        around.select(F.col("long").alias("l"), F.col("short").alias("r"))
    ).distinct()
    return pairs.join(a, "l").join(b, "r").select("left_name", "right_name")


# ---------------------------------------------------------------- near-equal texts

_PAD = "\u0001"


def _tokens(text: Column, q: int) -> Column:
    """The q-letter pieces of a text, padded at both ends, each with the number of its occurrence: a multiset as a set."""
    padded = F.concat(F.lit(_PAD * (q - 1)), text, F.lit(_PAD * (q - 1)))
    grams = F.transform(F.sequence(F.lit(1), F.length(text) + (q - 1)), lambda i: F.substring(padded, i, F.lit(q)))
    once = lambda g: F.transform(g, lambda x, i: F.concat(x, F.lit(_PAD), F.size(F.filter(F.slice(g, F.lit(1), i + 1), lambda y: y == x))))
    return F.transform(F.array(grams), once)[0]


def _shared(n: Column, m: Column, edits: Column, q: int) -> Column:
    """Tokens that two texts of these lengths share at least: an edit touches ``q`` of them."""
    return (F.greatest(n, m) + (q - 1) - edits * q).cast("int")


def prefix_keys(texts: DataFrame, text: str, group: list[str], lengths, max_edits, frequency: DataFrame) -> DataFrame:
    """(group, text, q, n, place, token): the rarest tokens of every text, as many as a partner has to share one of.

    Of two texts that share T of their n and m tokens, the rarest n - T + 1 and m - T + 1 share one. Pieces of
    two letters serve pairs of lengths that have to share one, single letters the others.
    """
    low, high = lengths(F.col("_n"))
    sized = texts.withColumn("_n", F.length(text)).where(F.col("_n") > 0)
    partners = F.sequence(F.greatest(low, F.lit(1)).cast("int"), high.cast("int"))
    two = lambda m: _shared(F.col("_n"), m, max_edits(F.col("_n"), m), 2)
    one = lambda m: _shared(F.col("_n"), m, max_edits(F.col("_n"), m), 1)
    least = {2: F.array_min(F.filter(F.transform(partners, two), lambda t: t >= 1)), 1: F.array_min(F.transform(F.filter(partners, lambda m: two(m) < 1), one))}
    kinds = F.array(*[F.when(least[q].isNotNull(), F.struct(F.lit(q).alias("q"), least[q].alias("need"), _tokens(F.col(text), q).alias("tokens"))) for q in (2, 1)])
    rows = sized.select(*group, text, F.inline(F.array_compact(kinds)))
    # A text that need share nothing with some partner meets all such texts in a token that no text has.
    rows = rows.withColumn("tokens", F.when(F.col("need") < 1, F.concat("tokens", F.array(F.lit("")))).otherwise(F.col("tokens")))
    each = rows.select(*group, text, "q", "need", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    ranked = each.join(frequency, ["q", "token"], "left").groupBy(*group, text, "q", "need", "n").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("c"), "token"))).alias("t"))
    kept = F.slice("t", F.lit(1), F.greatest(F.lit(0), F.least(F.col("n"), F.col("n") - F.col("need") + 1)))
    return ranked.select(*group, text, "q", "n", F.posexplode(kept).alias("place", "t")).select(*group, text, "q", "n", "place", F.col("t.token").alias("token"))


def token_frequency(texts: list[tuple[DataFrame, str]]) -> DataFrame:
    """(q, token, count) over all texts; any one order of tokens will do, the rarest first makes the fewest candidates."""
    parts = [df.where(F.length(c) > 0).select(F.lit(q).alias("q"), F.explode(_tokens(F.col(c), q)).alias("token")) for df, c in texts for q in (2, 1)]
    return reduce(lambda a, b: a.unionByName(b), parts).groupBy("q", "token").agg(F.count("*").alias("count"))


def near_pairs(left: DataFrame, right: DataFrame, group: list[str], lengths: Callable[[Column], tuple[Column, Column]],
               max_edits: Callable[[Column, Column], Column]) -> DataFrame:
    """Candidate pairs (left_text, right_text) within an edit bound, none missed.

    Candidates share one of their rarest pieces, at places in the order of rarity that leave enough pieces
    for what the pair has to share; those that stay must share that many pieces, counted with repeats. All of
    it is built-in functions. ``lengths`` gives the partner lengths worth trying, ``max_edits`` the edits for two
    lengths, an edit being one letter put in, left out or replaced.
    """
    a, b = spread(left.select(*group, "left_text").distinct()), spread(right.select(*group, "right_text").distinct())
    frequency = reliable_checkpoint(token_frequency([(a, "left_text"), (b, "right_text")]))
    a_keys = prefix_keys(a, "left_text", group, lengths, max_edits, frequency).withColumnsRenamed({"n": "n_a", "place": "at_a"})
    b_keys = prefix_keys(b, "right_text", group, lengths, max_edits, frequency).withColumnsRenamed({"n": "n_b", "place": "at_b"})
    la, lb = F.length("left_text"), F.length("right_text")
    need = {q: _shared(la, lb, max_edits(la, lb), q) for q in (1, 2)}
    low, high = lengths(la)
    fits = (lb >= low) & (lb <= high) & (F.when(need[2] >= 1, 2).otherwise(1) == F.col("q"))
    wanted = F.when(F.col("q") == 2, need[2]).otherwise(need[1])
    met = a_keys.join(b_keys, [*group, "q", "token"]).where(fits & (F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= wanted))
    pairs = met.select(*group, "left_text", "right_text", "q").distinct()
    both = lambda q: F.size(F.array_intersect(_tokens(F.col("left_text"), q), _tokens(F.col("right_text"), q)))
    enough = F.when(F.col("q") == 2, both(2) >= need[2]).otherwise(both(1) >= need[1])
    return pairs.where(enough).drop("q")


def _segments(length: Column, k: Column) -> Column:
    """Even cut of a text into k + 1 pieces: array of (piece number, start from 0, length)."""
    parts = k + 1
    at = lambda i: F.floor(i * length / parts).cast("int")
    return F.transform(F.sequence(F.lit(0), k), lambda i: F.struct(i.alias("i"), at(i).alias("start"), (at(i + 1) - at(i)).alias("len")))


def segment_pairs(left: DataFrame, right: DataFrame, group: list[str], lengths: Callable[[Column], tuple[Column, Column]],
               max_edits: Callable[[Column, Column], Column]) -> DataFrame:
    """Candidate pairs (left_text, right_text) within a bound of few edits, none missed.

    The right text is cut into one piece more than the allowed edits; at least one piece then
    survives unchanged in the left text, shifted by no more than the edits. So candidates come from
    an equi-join on (group, lengths, piece), and its cost follows shared pieces, not group size.
    ``lengths`` gives the partner lengths worth trying, ``max_edits`` the edits for two lengths.
    """
    a = spread(left.select(*group, "left_text").distinct()).withColumn("la", F.length("left_text"))
    b = spread(right.select(*group, "right_text").distinct()).withColumn("lb", F.length("right_text"))

    def span(n):
        low, high = lengths(F.col(n))
        return F.explode(F.sequence(F.greatest(low, F.lit(1)).cast("int"), high.cast("int")))

    b_keys = b.withColumn("la", span("lb")).withColumn("k", max_edits(F.col("la"), F.col("lb")).cast("int"))
    b_keys = b_keys.withColumn("s", F.explode(_segments(F.col("lb"), F.col("k"))))
    b_keys = b_keys.select(*group, "right_text", "la", "lb", F.col("s.i").alias("i"),
                           F.substring("right_text", F.col("s.start") + 1, F.col("s.len")).alias("piece"))
    a_keys = a.withColumn("lb", span("la")).withColumn("k", max_edits(F.col("la"), F.col("lb")).cast("int"))
    a_keys = a_keys.withColumn("s", F.explode(_segments(F.col("lb"), F.col("k"))))
    low = F.greatest(F.lit(0), F.col("s.start") - F.col("k"))
    high = F.least(F.col("la") - F.col("s.len"), F.col("s.start") + F.col("k"))
    starts = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    pieces = F.array_distinct(F.transform(starts, lambda p: F.substring("left_text", p + 1, F.col("s.len"))))
    a_keys = a_keys.select(*group, "left_text", "la", "lb", F.col("s.i").alias("i"), F.explode(pieces).alias("piece"))
    return a_keys.join(b_keys, [*group, "la", "lb", "i", "piece"]).select(*group, "left_text", "right_text").distinct()


def sequence_ratio():
    """Longest-matching-blocks similarity of two texts, per Arrow batch.

    Built inside a function so that it ships to the workers by value.
    """

    def ratio(candidate: pd.Series, word: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, a, b).ratio() for a, b in zip(candidate, word)], dtype="float64")

    return F.pandas_udf(ratio, T.DoubleType())


def closest_text(words: DataFrame, dictionary: DataFrame, group: list[str], cutoff: float = 0.85) -> DataFrame:
    """The best dictionary text of the group with a ratio of at least ``cutoff``.

    ``words`` has ``left_text``, ``dictionary`` has ``right_text``. The greater text wins a tie.
    """
    spare = 1 - cutoff
    pairs = near_pairs(
        words, dictionary, group,
        lengths=lambda n: (F.ceil(n * cutoff / (2 - cutoff) - 1e-9), F.floor(n * (2 - cutoff) / cutoff + 1e-9)),
        max_edits=lambda x, y: F.floor((x + y) * spare + 1e-9),
    )
    scored = pairs.withColumn("ratio", sequence_ratio()("right_text", "left_text")).where(F.col("ratio") >= cutoff)
    best = scored.groupBy(*group, "left_text").agg(F.max(F.struct("ratio", "right_text")).alias("b"))
    return best.select(*group, "left_text", F.col("b.right_text").alias("match"), F.col("b.ratio").alias("ratio"))


def closest_by_edits(words: DataFrame, dictionary: DataFrame, group: list[str], edits: int) -> DataFrame:
    """J16, edit-distance form: the nearest dictionary text within ``edits``; the smaller text wins a tie."""
    pairs = segment_pairs(words, dictionary, group, lengths=lambda n: (n - edits, n + edits), max_edits=lambda x, y: F.least(F.lit(edits), x + y))
    scored = pairs.withColumn("distance", F.levenshtein("left_text", "right_text", edits)).where(F.col("distance") >= 0)
    best = scored.groupBy(*group, "left_text").agg(F.min(F.struct("distance", "right_text")).alias("b"))
    return best.select(*group, "left_text", F.col("b.right_text").alias("match"), F.col("b.distance").alias("distance"))


# ---------------------------------------------------------------- key repair

CRITERIA = ["Customer", "State", "Date"]
SUBSETS = [c for n in (3, 2, 1, 0) for c in combinations(CRITERIA, n)]
NO_DAY = "1000-01-01"
_SMALLEST = 5
_GROUP = ["subset", "prefix", "k_cust", "k_state"]


def _days(c: str) -> Column:
    """Days since the filler day, which itself is 0."""
    return F.datediff(F.col(c), F.lit(NO_DAY).cast("date"))


def _id(subset: tuple[str, ...]) -> str:
    return "+".join(subset)


def _kept(subset) -> list[Column]:
    """Key columns of one count: values of its criteria, fixed fillers for the others."""
    has = lambda c: c in subset
    return [
        F.lit(_id(subset)).alias("subset"), (F.col("cust") if has("Customer") else F.lit("")).alias("k_cust"),
        (F.col("state") if has("State") else F.lit("")).alias("k_state"), (_days("day") if has("Date") else F.lit(0)).alias("on_day")]


def _given(column: str, criterion: str, subset) -> Column:
    return F.col(column).isNotNull() if criterion in subset else F.lit(True)


def smallest_so_far(df: DataFrame, value: str, within: list[str], order: list[Column], out: str, k: int = _SMALLEST) -> DataFrame:
    """Adds ``out``: the ``k`` smallest values of ``value`` up to each row, as an array in order.

    A running minimum keeps the smallest; what it does not keep - the greater of a new value and the
    minimum so far - goes on to the next running minimum, and so on ``k`` times. All windows share one
    sort. ``order`` has to tell the rows of a window apart.
    """
    before = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    came = F.col(value)
    for i in range(k):
        df = df.withColumns({f"_came_{i}": came, f"_least_{i}": F.min(came).over(before)})
        old, new = F.col(f"_least_{i}"), F.col(f"_came_{i}")
        came = F.when(old.isNotNull() & new.isNotNull(), F.greatest(old, new))
    kept = F.array_compact(F.array(*[F.least(f"_least_{i}", f"_came_{i}") for i in range(k)]))
    return df.withColumn(out, kept).drop(*[f"_{c}_{i}" for i in range(k) for c in ("came", "least")])


def windowed_counts(marks: DataFrame, wanted: DataFrame, group: list[str], window: int) -> DataFrame:
    """n and first (the smallest codes) of each ``wanted`` (group, on_day, dated) over the marks around its day.

    ``marks`` (group, day, n, code, place) have a row with the count and the smallest code of every day, and up
    to four with its next codes. The days are cut into blocks as long as the span of 2 * window + 1 days, so a span is the end of one
    block and the beginning of the next: running counts and running smallest codes from both ends of the
    blocks, read off at the span's two bounds, make up its count and its codes. Nothing is repeated day by
    day, and a block has a bounded number of rows whatever the size of its group. Undated groups lie on day 0.
    """
    span = 2 * window + 1
    first, last = F.when(F.col("dated"), F.col("on_day") - window), F.when(F.col("dated"), F.col("on_day") + window).otherwise(F.col("on_day"))
    # Where the span is one whole block its end says it all.
    starts = F.when(F.col("dated") & (F.pmod(F.col("on_day") - window, F.lit(span)) != 0), F.struct(first.alias("day"), F.lit(True).alias("backward")))
    asks = F.array_compact(F.array(F.struct(last.alias("day"), F.lit(False).alias("backward")), starts))
    bounds = wanted.select(*group, "on_day", F.explode(asks).alias("a")).select(*group, "on_day", F.col("a.day").alias("day"), F.col("a.backward").alias("backward"))
    none = lambda kind: F.lit(None).cast(kind)
    rows = marks.select(*group, "day", "n", "code", "place", none("int").alias("on_day"), none("boolean").alias("backward")).unionByName(
        bounds.select(*group, "day", none("bigint").alias("n"), none("string").alias("code"), F.lit(_SMALLEST + 1).alias("place"), "on_day", "backward"))
    rows = rows.withColumn("_block", F.floor(F.col("day") / span))
    within = [*group, "_block"]
    ends = []
    for backward in (False, True):
        # A bound asks in one direction; bounds of the other are left out before the shuffle.
        own = rows.where(F.col("backward").isNull() | (F.col("backward") == backward)).drop("backward")
        order = [F.desc("day") if backward else F.asc("day"), F.asc("place"), F.asc("code"), F.asc("on_day")]
        upto = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        run = smallest_so_far(own.withColumn("total", F.sum("n").over(upto)), "code", within, order, "few")
        ends.append(run.where(F.col("on_day").isNotNull()).select(*group, "on_day", "total", "few"))
    both = ends[0].unionByName(ends[1])
    # One or two rows each, so the lists that meet are bounded.
    return both.groupBy(*group, "on_day").agg(
        F.sum("total").alias("n"), F.slice(F.array_sort(F.flatten(F.collect_list("few"))), 1, _SMALLEST).alias("first")).where("n > 0")


def _marks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of ``rows`` (keys, n, code) a row per key with the sum of n and the smallest code, and up to four with the next codes."""
    counts = rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("code").alias("code"))
    few = top_per_key(rows.select(*keys, "code"), keys, [F.asc("code")], _SMALLEST, "place").where("place > 1")
    return counts.select(*keys, "n", "code", F.lit(1).alias("place")).unionByName(few.select(*keys, F.lit(None).cast("bigint").alias("n"), "code", "place"))


def best_candidates(requests: DataFrame, codes: DataFrame, names: DataFrame, window: int = K.DATE_WINDOW_DAYS) -> DataFrame:
    """Best code, score, tie count and first tied codes for every distinct request.

    A request gets one point per criterion a code meets. Instead of pairing requests with codes,
    the codes are counted once per set of criteria - say all codes of a customer in a state - and a
    request looks its own values up in each of these counts. When no code meets all three criteria,
    the codes that meet two of them cannot be in two of the counts, so the counts simply add up;
    the same holds one level down. Work grows with requests plus codes, not with their product:
    codes of one prefix, customer, state and day are one count and a few codes before they meet the
    pairs of names or the requests (U08), and a span of days is read off at its bounds (J13).

    ``requests``: ``prefix, cust, state, day``; ``codes``: ``prefix, code, customer, state, day``;
    ``names``: pairs (cust, customer) that match. With a prefix every code that has it is a
    candidate; with the empty one only codes that share the customer or the state are.
    """
    asked = spread(requests.select("prefix", "cust", "state", "day").distinct())
    looked_up = F.array(*[
        F.when(
            _given("cust", "Customer", s) & _given("state", "State", s) & _given("day", "Date", s)
            & (F.lit(s not in ((), ("Date",))) | (F.col("prefix") != "")),
            F.struct(*_kept(s)))
        for s in SUBSETS])
    keyed = asked.select("prefix", "cust", "state", "day", F.explode(looked_up).alias("k")).where(F.col("k").isNotNull())
    keyed = reliable_checkpoint(keyed.select("prefix", "cust", "state", "day", "k.*"))
    dated = F.col("subset").contains("Date")
    wanted = keyed.select(*_GROUP, "on_day").distinct().withColumn("dated", dated)

    fact = ["prefix", "customer", "state", "released"]
    facts = codes.select("prefix", "customer", "state", F.col("day").alias("released"), "code", F.lit(1).cast("bigint").alias("n"))
    base = reliable_checkpoint(_marks(facts, fact))

    def listed(source: DataFrame, subsets: list) -> DataFrame:
        """One row per mark and set of criteria, with the day of release for counts by date and day 0 for others."""
        tags = F.array(*[F.struct(F.lit("Date" in s).alias("by_day"), F.lit(_id(s)).alias("subset"), F.lit("State" in s).alias("by_state")) for s in subsets])
        rows = source.select("prefix", "k_cust", "state", "released", "n", "code", F.inline(tags))
        rows = rows.where((~F.col("by_day") | F.col("released").isNotNull()) & (~F.col("by_state") | F.col("state").isNotNull()))
        return rows.select(
            "subset", "prefix", "k_cust", F.when(F.col("by_state"), F.col("state")).otherwise(F.lit("")).alias("k_state"),
            F.when(F.col("by_day"), _days("released")).otherwise(F.lit(0)).alias("day"), "n", "code")

    named = base.join(names, "customer").withColumnRenamed("cust", "k_cust")
    plain = base.withColumn("k_cust", F.lit(""))
    rows = listed(named, [s for s in SUBSETS if "Customer" in s]).unionByName(listed(plain, [s for s in SUBSETS if "Customer" not in s]))
    rows = rows.join(wanted.select(*_GROUP).distinct(), _GROUP, "left_semi")
    marks = reliable_checkpoint(_marks(rows, [*_GROUP, "day"]))
    # Nobody has to look where no code lies.
    wanted = reliable_checkpoint(wanted.join(marks.select(*_GROUP).distinct(), _GROUP, "left_semi"))
    counted = windowed_counts(marks, wanted, _GROUP, window)
    found = keyed.join(counted, [*_GROUP, "on_day"])
    wide = found.groupBy("prefix", "cust", "state", "day").agg(
        *[F.max(F.when(F.col("subset") == _id(s), F.col("n"))).alias(_n(s)) for s in SUBSETS],
        *[F.max(F.when(F.col("subset") == _id(s), F.col("first"))).alias(_t(s)) for s in SUBSETS])
    return _pick(wide)


def _n(subset) -> str:
    return "n_" + ("_".join(subset) or "Base")


def _t(subset) -> str:
    return "t_" + ("_".join(subset) or "Base")


def _pick(counted: DataFrame) -> DataFrame:
    n = lambda s: F.coalesce(F.col(_n(s)), F.lit(0).cast("bigint"))
    none = F.array().cast("array<string>")
    level = lambda size: [s for s in SUBSETS if len(s) == size]
    total = lambda size: reduce(lambda a, b: a + b, [n(s) for s in level(size)])
    firsts = lambda size: F.concat(*[F.coalesce(F.col(_t(s)), none) for s in level(size)])
    by_level = lambda value: (
        F.when(total(3) > 0, value(3)).when(total(2) > 0, value(2)).when(total(1) > 0, value(1)).when(total(0) > 0, value(0)))
    pool = F.when(F.col("prefix") != "", n(())).otherwise(n(("Customer",)) + n(("State",)) - n(("Customer", "State")))
    picked = counted.withColumns({
        "met": by_level(F.lit), "tied": by_level(total), "pool": pool,
        "first_tied": F.slice(F.array_sort(by_level(firsts)), 1, _SMALLEST),
    }).withColumn("best_code", F.get("first_tied", F.lit(0)))
    named = lambda s: F.array_contains(F.coalesce(F.col(_t(s)), none), F.col("best_code"))
    method = F.coalesce(*[F.when((F.col("met") == len(s)) & named(s), F.lit(_id(s))) for s in SUBSETS], F.lit(""))
    return picked.withColumn("criteria", method).select(
        "prefix", "cust", "state", "day", "best_code", "met", "criteria", "tied", "first_tied", "pool")


def _notes(is_null: Column) -> Column:
    tie = F.concat(
        F.lit("Tied "), F.col("tied"), F.lit(" candidates at score "), F.col("score"), F.lit(": "), F.array_join("first_tied", ", "),
        F.when(F.col("tied") > _SMALLEST, F.concat(F.lit(" (+"), F.col("tied") - _SMALLEST, F.lit(" more)"))).otherwise(F.lit("")),
    )
    single = F.concat(F.lit("Single prefix match -> "), F.col("best_code"))
    best = F.concat(F.lit("Best of "), F.col("pool"), F.lit(" candidates (score "), F.col("score"), F.lit(")"))
    return F.when(F.col("tied") > 1, tie).when(~is_null & (F.col("pool") == 1), single).otherwise(best)


def repair_keys(rows: DataFrame, registry: DataFrame, first_day: str = K.FIRST_CODED_DAY,
                manual: list[str] | None = None, window: int = K.DATE_WINDOW_DAYS) -> DataFrame:
    """Every row with its repaired code, status, confidence, method and notes.

    ``rows`` has ``raw_code, customer, state, ship_day``; ``registry`` has ``code, customer, state,
    released`` with three-letter codes. Only distinct (code, customer, state, day) requests are
    matched; their verdicts are joined back.
    """
    manual = manual if manual is not None else K.MANUAL_PARTIALS
    asked_columns = ["raw_code", "customer", "state", "ship_day"]
    raw = F.coalesce(F.trim("raw_code"), F.lit(""))
    asked = rows.select(*asked_columns).distinct().withColumns({
        "raw": raw, "upper_code": F.upper(raw), "cust": F.nullif(F.trim("customer"), F.lit("")),
        "request_state": F.nullif(F.upper(F.trim("state")), F.lit("")),
    })
    codes = registry.select("code", F.col("customer"), F.nullif(F.upper(F.trim("state")), F.lit("")).alias("state"),
                            F.col("released").alias("day"))
    valid = codes.select(F.col("code").alias("upper_code"), F.lit(True).alias("is_valid")).distinct()
    head = valid.select(F.col("upper_code").alias("head"), F.col("is_valid").alias("head_valid"))
    asked = asked.withColumn("head", F.when(F.length("upper_code") > 3, F.substring("upper_code", 1, 3)))
    asked = asked.join(valid, "upper_code", "left").join(head, "head", "left")
    early = F.coalesce(F.col("ship_day") < F.lit(first_day).cast("date"), F.lit(False))
    branch = (
        F.when(F.col("is_valid") & F.col("upper_code").rlike("^[A-Z]{3}$"), "ok")
        .when(early, "early")
        .when(F.col("raw") == "", "null")
        .when(F.col("upper_code").isin(manual), "manual")
        .when(F.col("head_valid"), "long")
        .otherwise("prefix")
    )
    # Both tables are read once per count below, so they are worked out once and kept.
    asked = reliable_checkpoint(asked.withColumns({"branch": branch, "prefix": F.substring("upper_code", 1, 2)}))
    codes = reliable_checkpoint(codes)
    names = names_either_way(
        asked.where(F.col("branch").isin("null", "prefix") & F.col("cust").isNotNull()).select(F.col("cust").alias("left_name")),
        codes.where(F.col("customer").isNotNull()).select(F.col("customer").alias("right_name")),
    ).select(F.col("left_name").alias("cust"), F.col("right_name").alias("customer"))

    heads = F.array(F.lit(""), F.substring("code", 1, 1), F.substring("code", 1, 2))
    prefixed = codes.select("*", F.explode(heads).alias("prefix"))
    own = asked.where(F.col("branch").isin("null", "prefix")).select(
        *asked_columns, "raw", "branch", "prefix", "cust", F.col("request_state").alias("_state"), F.col("ship_day").alias("_day"))
    keyed = own.select("prefix", "cust", F.col("_state").alias("state"), F.col("_day").alias("day"))
    best = best_candidates(keyed, prefixed, names, window).withColumnsRenamed({"state": "_state", "day": "_day"})
    scored = join_null_safe(own, best, ["prefix", "cust", "_state", "_day"])
    verdicts = [_fixed(asked), _manual(asked, prefixed), _verdict(scored)]
    verdict = reduce(lambda a, b: a.unionByName(b), verdicts)
    return join_null_safe(rows, verdict, asked_columns)


VERDICT = ["fixed_code", "repair_status", "repair_confidence", "repair_method", "repair_notes"]


def _verdict_columns(df: DataFrame, **values: Column) -> DataFrame:
    cols = [values[v].cast("string").alias(v) for v in VERDICT]
    return df.select("raw_code", "customer", "state", "ship_day", *cols)


def _fixed(asked: DataFrame) -> DataFrame:
    """Valid codes, rows older than the codes, and long codes that start with a valid one."""
    b, raw, day = F.col("branch"), F.col("raw"), F.col("ship_day").cast("string")
    early = F.when(raw == "", F.concat(F.lit("Shipped "), day, F.lit(" predates the code system"))).otherwise(
        F.concat(F.lit("Partial code '"), raw, F.lit("' on "), day, F.lit(" predates the code system")))
    long = F.concat(F.lit("'"), raw, F.lit("' -> '"), F.col("head"), F.lit("'. Starts with valid code '"), F.col("head"), F.lit("'"))
    return _verdict_columns(
        asked.where(b.isin("ok", "early", "long")),
        fixed_code=F.when(b == "ok", F.col("upper_code")).when(b == "long", F.col("head")).otherwise(F.lit("")),
        repair_status=F.when(b == "ok", "OK").when(b == "early", "PRE-2016").otherwise("REPAIRED"),
        repair_confidence=F.when(b == "long", "High").otherwise("n/a"),
        repair_method=F.when(b == "long", "Truncated(exact prefix)").otherwise(""),
        repair_notes=F.when(b == "early", early).when(b == "long", long).otherwise(""),
    )


def _manual(asked: DataFrame, prefixed: DataFrame) -> DataFrame:
    """Ambiguous partials go to a person, with every code they could mean (at most 676)."""
    wanted = asked.where(F.col("branch") == "manual").select(F.col("upper_code").alias("prefix")).distinct()
    choices = prefixed.where(F.col("prefix") != "").join(wanted, "prefix", "left_semi").groupBy(F.col("prefix").alias("upper_code")).agg(
        F.array_join(F.array_sort(F.collect_set("code")), ", ").alias("choices"))
    own = asked.where(F.col("branch") == "manual").join(choices, "upper_code", "left")
    notes = F.concat(F.lit("'"), F.col("raw"), F.lit("' flagged for manual review. Candidates: "), F.coalesce("choices", F.lit("none found")))
    return _verdict_columns(own, fixed_code=F.lit(""), repair_status=F.lit("NEEDS_REVIEW"), repair_confidence=F.lit("Manual"),
                            repair_method=F.lit("Prefix"), repair_notes=notes)


def _verdict(best: DataFrame) -> DataFrame:
    is_null = F.col("branch") == "null"
    # The prefix point counts only when the row's own text, as written, starts the code.
    point = F.when(~is_null & (F.col("raw") == F.col("prefix")), 1).otherwise(0)
    scored = best.withColumns({"point": point, "score": F.coalesce(F.col("met") + point, F.lit(0))})
    scored = scored.withColumn("notes", _notes(is_null))
    s, found = F.col("score"), F.col("best_code").isNotNull()
    prefix = F.when(F.col("point") == 1, F.lit("Prefix"))
    method = F.concat_ws("+", prefix, F.nullif("criteria", F.lit("")))
    good = F.when(is_null, s >= 2).otherwise(s >= 1)
    quoted = F.concat(F.lit("'"), F.col("raw"), F.lit("'"))
    arrow = F.concat(quoted, F.lit(" -> '"), F.col("best_code"), F.lit("'"))
    undated = F.when(F.col("ship_day").isNull(), F.lit("[No ship date] ")).otherwise(F.lit(""))
    unfixed = F.when(found, F.concat(F.lit("All candidates scored 0 (tried "), F.col("pool"), F.lit(" codes)"))).otherwise(
        F.concat(F.lit("No registry code starts with "), quoted))
    notes = (
        F.when(is_null & good, F.concat(undated, F.col("notes")))
        .when(is_null & found, F.col("notes"))
        .when(is_null, F.lit("No customer or state match found in registry"))
        .when(s >= 2, F.concat(arrow, F.lit(". "), F.col("notes")))
        .when(s == 1, F.concat(arrow, F.lit(" (low confidence). "), F.col("notes")))
        .otherwise(F.concat(quoted, F.lit(" not fixable. "), unfixed))
    )
    return _verdict_columns(
        scored,
        fixed_code=F.when(good, F.col("best_code")).otherwise(F.lit("")),
        repair_status=F.when(~good, "UNRESOLVABLE").when(is_null, "ATTRIBUTED").otherwise("REPAIRED"),
        repair_confidence=F.when(good, confidence_tier("score")).otherwise(F.lit("n/a")),
        repair_method=F.when(s > 0, method).otherwise(F.lit("")),
        repair_notes=notes,
    )


def repair_breakdown(repaired: DataFrame, columns: list[str]) -> DataFrame:
    """Rows by status or confidence with their part of the total."""
    return share(repaired.groupBy(*columns).agg(F.count("*").alias("rows")), "rows", "share")


def rejected_rows(repaired: DataFrame, row_no: str, columns: list[str]) -> DataFrame:
    """the log of every row whose code was not right as it came."""
    return repaired.where(F.col("repair_status") != "OK").select(row_no, *columns, *VERDICT)
