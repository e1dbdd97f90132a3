"""Text joins and key repair against brute force."""

import datetime as dt
import random
from difflib import SequenceMatcher, get_close_matches

from pyspark.sql import functions as F

from plumbline.operators import geocode, match

CITIES = ["SPRINGFIELD", "SPRINGFEILD", "SAINT PAUL", "ST PAUL", "RENO", "RENNO", "ELKO", "FORT WORTH", "FT WORTH", "LAS VEGAS", "LOS VEGAS",
          "NORTH LAS VEGAS", "HENDERSON", "HENDERSEN", "CARSON CITY", "CARSONCITY", "A", "AB", "BOULDER CITY", "BOULDER", "MESQUITE", "MESQITE"]


def _misspelt(rng, word):
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1:], word[:i] + "X" + word[i:], word[:i] + "Q" + word[i + 1:], word[::-1], word]) or "Z"


def test_closest_text_equals_close_matches(spark):
    rng = random.Random(5)
    words = sorted({_misspelt(rng, rng.choice(CITIES)) for _ in range(120)})
    got = match.closest_text(
        spark.createDataFrame([("NV", w) for w in words], "state string, left_text string"),
        spark.createDataFrame([("NV", c) for c in CITIES] + [("UT", "ZION")], "state string, right_text string"), ["state"])
    got = {r.left_text: r.match for r in got.collect()}
    want = {w: m[0] for w in words if (m := get_close_matches(w, CITIES, n=1, cutoff=0.85))}
    assert got == want


def test_near_pairs_miss_nothing(spark):
    rng = random.Random(11)
    alphabet = "AB"
    left = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12))) for _ in range(80)})
    right = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 12))) for _ in range(80)})
    got = match.closest_text(spark.createDataFrame([(1, w) for w in left], "g int, left_text string"), spark.createDataFrame([(1, w) for w in right], "g int, right_text string"), ["g"], 0.7)
    got = {r.left_text: (round(r.ratio, 9), r.match) for r in got.collect()}
    want = {}
    for a in left:
        best = max((round(SequenceMatcher(None, b, a).ratio(), 9), b) for b in right)
        if best[0] >= 0.7:
            want[a] = best
    assert got == want


def test_long_names_have_few_keys(spark):
    rng = random.Random(6)
    names = ["".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ ", k=40)) for _ in range(200)]
    df = spark.createDataFrame([("g", n) for n in names], "g string, left_text string")
    lengths, edits = (lambda n: (F.ceil(n * 0.85 / 1.15 - 1e-9), F.floor(n * 1.15 / 0.85 + 1e-9))), (lambda x, y: F.floor((x + y) * 0.15 + 1e-9))
    keys = match.prefix_keys(df, "left_text", ["g"], lengths, edits, match.token_frequency([(df, "left_text")]))
    # Cut into pieces that shift by every allowed edit, for every allowed length, a name of 40 letters had more than 1,000.
    assert keys.count() <= 60 * len(names)


def test_near_pairs_by_edits_miss_nothing(spark):
    rng = random.Random(12)
    words = sorted({"".join(rng.choice("ABC") for _ in range(rng.randint(1, 9))) for _ in range(150)})
    got = match.closest_by_edits(spark.createDataFrame([(1, w) for w in words[::2]], "g int, left_text string"), spark.createDataFrame([(1, w) for w in words[1::2]], "g int, right_text string"), ["g"], 2)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    want = {a: min((distance(a, b), b) for b in words[1::2]) for a in words[::2]}
    assert {r.left_text: (r.distance, r.match) for r in got.collect()} == {a: w for a, w in want.items() if w[0] <= 2}


def test_names_either_way(spark):
    left = ["Acme Co", "acme", "Bolt", "", "Zed Works", "a", "Mid"]
    right = ["ACME", "bolt & nut", "Works", "Mi", "x", "Acme Company"]
    got = match.names_either_way(spark.createDataFrame([(x,) for x in left], "left_name string"), spark.createDataFrame([(x,) for x in right], "right_name string"))
    want = {(a, b) for a in left for b in right if a and b and (a.lower() in b.lower() or b.lower() in a.lower())}
    assert {(r.left_name, r.right_name) for r in got.collect()} == want


def _brute(row, registry):
    raw, cust, state, day = row
    code = (raw or "").upper()
    hits = []
    for c, customer, st, released in registry:
        prefix = bool(code) and c.startswith(code[:2])
        same = bool(cust and customer) and (cust.lower() in customer.lower() or customer.lower() in cust.lower())
        where = bool(state and st) and state.upper() == st
        near = bool(day and released) and abs((day - released).days) <= 180
        if (code and prefix) or (not code and (same or where)):
            hits.append((-((1 if code and raw == code[:2] else 0) + same + where + near), c))
    return min(hits) if hits else None


def test_repair_equals_brute_force(spark):
    rng = random.Random(9)
    day = lambda: dt.date(2018, 1, 1) + dt.timedelta(days=rng.randrange(1200))
    registry = [("".join(p), rng.choice(["Acme", "Bolt", None, "Cog Works"]), rng.choice(["NV", "CA", None]), rng.choice([day(), None]))
                for p in sorted({(rng.choice("ABC"), rng.choice("ABCD"), rng.choice("ABCDEFGH")) for _ in range(70)})]
    raws = [None, "", "A", "AB", "ab", "AB9", "C", "ZZ", "BVX", "BV", registry[0][0], registry[0][0] + "Q"]
    rows = [(i, rng.choice(raws), rng.choice(["Acme Co", "bolt", None, "Nobody"]), rng.choice(["NV", "ca", None]), rng.choice([day(), day(), None, dt.date(2015, 5, 5)])) for i in range(150)]
    df = spark.createDataFrame(rows, "n int, raw_code string, customer string, state string, ship_day date")
    reg = spark.createDataFrame(registry, "code string, customer string, state string, released date")
    got = {r.n: r for r in match.repair_keys(df, reg).collect()}
    again = {r.n: r for r in match.repair_keys(df.repartition(5), reg.repartition(3)).collect()}
    assert got == again and len(got) == len(rows)
    valid = {r[0] for r in registry}
    for n, raw, cust, state, day_ in rows:
        code, r = (raw or "").upper(), got[n]
        if code in valid:
            assert (r.fixed_code, r.repair_status) == (code, "OK")
        elif day_ and day_ < dt.date(2016, 1, 1):
            assert r.repair_status == "PRE-2016"
        elif code == "BV":
            assert r.repair_status == "NEEDS_REVIEW"
        elif len(code) > 3 and code[:3] in valid:
            assert (r.fixed_code, r.repair_confidence) == (code[:3], "High")
        else:
            best = _brute((raw, cust, state, day_), registry)
            points = -best[0] if best else 0
            if points >= (1 if code else 2):
                assert r.fixed_code == best[1] and r.repair_status == ("REPAIRED" if code else "ATTRIBUTED"), (n, r, best)
            else:
                assert (r.fixed_code, r.repair_status) == ("", "UNRESOLVABLE"), (n, r, best)


def _brute_best(request, codes, names, window):
    prefix, cust, state, day = request
    met = []
    for p, code, customer, st, released in codes:
        if p != prefix:
            continue
        same, where = (cust, customer) in names, state is not None and state == st
        if prefix or same or where:
            met.append((same + where + (day is not None and released is not None and abs((day - released).days) <= window), code))
    if not met:
        return None
    top = max(m for m, _ in met)
    tied = sorted(c for m, c in met if m == top)
    return tied[0], top, len(tied), tied[:5], len(met)


def test_best_candidates_equal_brute_force_over_many_blocks(spark):
    rng = random.Random(21)
    for window in (0, 3, 180):
        day = lambda: dt.date(2019, 1, 1) + dt.timedelta(days=rng.randrange(8 * window + 12))
        codes = [(rng.choice(["", "A", "AB"]), f"C{rng.randrange(400):03d}", rng.choice(["x", "y", "z", None]), rng.choice(["NV", "CA", None]), rng.choice([day(), day(), None])) for _ in range(500)]
        names = {("X", "x"), ("X", "y"), ("Y", "y"), ("Q", "q")}
        requests = [(rng.choice(["", "A", "AB", "Z"]), rng.choice(["X", "Y", "Q", None]), rng.choice(["NV", "CA", "UT", None]), rng.choice([day(), None])) for _ in range(120)]
        got = match.best_candidates(
            spark.createDataFrame(requests, "prefix string, cust string, state string, day date"),
            spark.createDataFrame(codes, "prefix string, code string, customer string, state string, day date"),
            spark.createDataFrame(sorted(names), "cust string, customer string"), window)
        got = {(r.prefix, r.cust, r.state, r.day): (r.best_code, r.met, r.tied, r.first_tied, r.pool) for r in got.collect() if r.best_code}
        want = {r: _brute_best(r, codes, names, window) for r in requests}
        assert got == {r: w for r, w in want.items() if w}


def test_smallest_so_far(spark):
    rng = random.Random(2)
    rows = [(g, i, rng.choice([None, f"{rng.randrange(60):02d}"])) for g in range(4) for i in range(50)]
    got = match.smallest_so_far(spark.createDataFrame(rows, "g int, i int, v string"), "v", ["g"], [F.asc("i")], "few", 3)
    for r in got.collect():
        assert r.few == sorted(v for g, i, v in rows if g == r.g and i <= r.i and v is not None)[:3]


def _rows_made(df):
    """The largest number of rows that any step of the plan put out."""
    df.collect()
    found, stack = 0, [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            stack.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            stack.append(node.plan())
            continue
        metric = node.metrics().get("numOutputRows")
        if metric.isDefined():
            found = max(found, metric.get().value())
        stack += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_a_span_of_days_is_read_off_at_its_bounds(spark):
    days, asked = 2_000, 500
    at = lambda c: F.col(c).cast("int")
    marks = spark.range(days).select(F.lit("g").alias("g"), (at("id") * 2).alias("day"), F.explode(F.array(
        F.struct(F.lit(3).cast("bigint").alias("n"), F.lit(None).cast("string").alias("code"), F.lit(0).alias("place")),
        F.struct(F.lit(None).cast("bigint").alias("n"), F.lpad(((at("id") * 7919) % days).cast("string"), 5, "0").alias("code"), F.lit(1).alias("place")))).alias("m")).select("g", "day", "m.*")
    wanted = spark.range(asked).select(F.lit("g").alias("g"), (at("id") * 9 - 100).alias("on_day"), F.lit(True).alias("dated"))
    counted = match.windowed_counts(marks, wanted, ["g"], 180)
    assert _rows_made(counted) <= 2 * days + 2 * asked
    for r in counted.collect():
        inside = [i for i in range(days) if abs(2 * i - r.on_day) <= 180]
        assert (r.n, r.first) == (3 * len(inside), sorted(f"{i * 7919 % days:05d}" for i in inside)[:5])


def test_codes_are_counted_before_they_meet_names(spark):
    codes = spark.range(20_000).select(F.lit("A").alias("prefix"), F.concat(F.lit("A"), F.col("id")).alias("code"), F.lit("hot").alias("customer"),
                                       F.lit("NV").alias("state"), (F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 3).cast("int"))).alias("day"))
    names = spark.range(300).select(F.concat(F.lit("n"), F.col("id")).alias("cust"), F.lit("hot").alias("customer"))
    requests = names.select(F.lit("A").alias("prefix"), "cust", F.lit("NV").alias("state"), F.lit(dt.date(2020, 1, 2)).alias("day"))
    facts = codes.select("prefix", "customer", "state", F.col("day").alias("released"), "code", F.lit(1).cast("bigint").alias("n"))
    marks = match._marks(facts, ["prefix", "customer", "state", "released"])
    # Three days with five codes each, for each of 300 names; not 20,000 codes for each.
    assert marks.join(names, "customer").count() == 300 * 3 * 5
    got = match.best_candidates(requests, codes, names).collect()
    assert len(got) == 300 and {(r.best_code, r.met, r.tied) for r in got} == {("A0", 3, 20_000)}


def test_geocode_uses_near_names_last(spark):
    gaz = spark.createDataFrame([
        (0, "89001", "ALAMO", "NV", "LINCOLN", 37.0, -115.0), (1, "89002", "HENDERSON", "NV", "CLARK", 36.0, -114.0), (2, "84001", "SAINT GEORGE", "UT", "WASHINGTON", 37.1, -113.5),
        (3, "89001", "ALAMO", "NV", "LINCOLN", 38.0, -116.0)], "row_no bigint, zip string, city string, state string, county string, lat double, lng double")
    asked = spark.createDataFrame([
        ("HENDERSEN", "NV", None), ("ST GEORGE", "UT", None), ("ALAMO", "CA", None), ("NOWHERE", "NV", None), (None, None, "89001"), (None, None, None), ("ALAMO", "UT", "84001")],
        "city string, state string, zip string")
    got = {(r.city, r.state, r.zip): (r.placed_state, r.lat, r.prec, r.corrected) for r in geocode.geocode(asked, gaz, geocode.state_centroids(spark)).collect()}
    assert got == {
        ("HENDERSEN", "NV", None): ("NV", 36.0, 1, False), ("ST GEORGE", "UT", None): ("UT", 37.1, 1, False),
        ("ALAMO", "CA", None): ("NV", 37.5, 1, True), ("NOWHERE", "NV", None): ("NV", 39.33, 2, False),
        (None, None, "89001"): (None, 38.0, 0, False), (None, None, None): (None, None, None, False),
        # The zip lies in the listed state, so the state stays and the place is suspect.
        ("ALAMO", "UT", "84001"): ("UT", 37.1, 3, False),
    }
