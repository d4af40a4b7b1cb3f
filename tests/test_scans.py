"""Running values in groups of any size, against plain loops; one key holds more than a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from claimloom.operators import relational, scans, trees


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = [(rng.choice(["hot", "hot", "a", "b", None]), at, rng.choice([None, 1, 2, 5, -3]), rng.random() < 0.1, rng.random() < 0.1) for at in rng.sample(range(4000), 1500)]
    return spark.createDataFrame(data, "k string, at bigint, v bigint, wanted boolean, barrier boolean"), data


def _groups(data):
    out = {}
    for r in sorted(data, key=lambda r: r[1]):
        out.setdefault(r[0], []).append(r)
    return out


def test_running_values_in_many_parts(rows):
    df, data = rows
    last = lambda xs: next((x for x in reversed(xs) if x is not None), None)
    for before in (False, True):
        values = {"s": ("sum", F.col("v")), "hi": ("max", F.col("v")), "lo": ("min", F.col("v")), "l": ("last", F.col("v"))}
        got = {(r.k, r.at): (r.s, r.hi, r.lo, r.l) for r in scans.scan(df, ["k"], ["at"], values, before=before, parts=16).collect()}
        want = {}
        for k, group in _groups(data).items():
            for i, r in enumerate(group):
                vs = [x[2] for x in group[: i + (not before)]]
                some = [v for v in vs if v is not None]
                want[k, r[1]] = (sum(some), max(some, default=None), min(some, default=None), last(vs))
        assert got == want


def test_a_group_is_dealt_over_parts(rows):
    df, data = rows
    held = scans.in_parts(df, ["k"], ["at"], 16)
    sizes = [r["count"] for r in held.groupBy("_scan_part").count().collect()]
    assert len(sizes) > 10 and max(sizes) < len(data) / 6
    assert held.where("k = 'hot'").select("_scan_part").distinct().count() > 4


def test_places_and_sessions(rows):
    df, data = rows
    got = {(r.k, r.at): r.n for r in scans.numbered(df, ["k"], ["at"], "n", parts=16).collect()}
    assert got == {(k, r[1]): i + 1 for k, g in _groups(data).items() for i, r in enumerate(g)}
    got = {(r.k, r.at): r.run for r in scans.sessions(df, ["k"], "at", 8, "run", parts=16).collect()}
    want = {}
    for k, group in _groups(data).items():
        run, prev = 0, None
        for r in group:
            run += prev is None or r[1] - prev > 8
            prev = r[1]
            want[k, r[1]] = run
    assert got == want and max(want.values()) > 20


def test_nearest_wanted_row_without_a_barrier(rows):
    df, data = rows
    got = {(r.k, r.at): r.anchor for r in scans.anchored(df, ["k"], ["at"], F.col("wanted"), F.col("barrier"), F.col("at"), "anchor", parts=16).collect()}
    want = {}
    for k, group in _groups(data).items():
        anchor = None
        for r in group:
            want[k, r[1]] = None if r[4] else anchor
            if r[3]:
                anchor = r[1]
            elif r[4]:
                anchor = None
    assert got == want


def test_edges(spark, rows):
    df, _ = rows
    assert scans.numbered(df.where("false"), ["k"], ["at"], "n").count() == 0
    again = scans.scan(df.withColumn("s", F.lit("old")), ["k"], ["at"], {"s": ("sum", F.col("v"))}, parts=4)
    assert again.columns.count("s") == 1 and dict(again.dtypes)["s"] == "bigint"
    with pytest.raises(ValueError):
        scans.scan(df.withColumn("_scan_part", F.lit(1)), ["k"], ["at"], {"s": ("sum", F.col("v"))})
    with pytest.raises(ValueError):
        scans.scan(df, ["k"], ["at"], {"s": ("mean", F.col("v"))})


def test_join_of_hot_keys(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 700).alias("k"), "id")
    keyed = left.groupBy("k").agg(F.count("*").alias("size"), F.max("id").alias("top"))
    plain = left.join(keyed.drop("size"), "k").select("k", "id", "top")
    got = relational.join_hot(left, keyed, ["k"], large=50)
    assert got.columns == ["k", "id", "top"] and sorted(got.collect()) == sorted(plain.collect())
    assert "BroadcastHashJoin" in got._jdf.queryExecution().toString()
    some = keyed.where("k <> -1 and k % 2 = 0")
    assert relational.join_hot(left, some, ["k"], large=50).count() == left.join(some, "k").count()


def test_spans_of_one_key_meet_in_bins(spark):
    rng = random.Random(8)
    spans = [("k", i, a, a + rng.choice([0, 1, 2, 3, 7, 40, 900])) for i, a in enumerate(rng.randrange(3000) for _ in range(400))]
    spans += [("j", 1000 + i, a, b) for i, (a, b) in enumerate([(0, 5), (5, 9), (4, 6), (5, 5), (-8, -3), (-4, 0)])] + [("k", 2000, None, 5), (None, 3000, 0, 4), (None, 3001, 0, 4)]
    want = sorted((k, i, j, max(a, c), min(b, d)) for k, i, a, b in spans for m, j, c, d in spans if k is not None and k == m and i < j and None not in (a, b, c, d) and a < d and b > c)
    got = relational.overlaps(spark.createDataFrame(spans, "k string, id int, start int, end int"), ["k"], "id")
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 500
    halves = [(k, i, a / 2, b / 2) for k, i, a, b in spans[:150]]
    got = relational.overlaps(spark.createDataFrame(halves, "k string, id int, start double, end double"), ["k"], "id")
    assert sorted((r.left_id, r.right_id) for r in got.collect()) == sorted((i, j) for _, i, a, b in halves for _, j, c, d in halves if i < j and a < d and b > c)


def test_many_short_spans_of_one_key_are_few_candidates(spark):
    n = 20_000
    spans = spark.range(n).select(F.lit("k").alias("k"), "id", (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 11).alias("end"))
    assert relational.overlaps(spans, ["k"], "id").count() == n - 1


def test_members_of_a_large_group_meet_in_blocks(spark):
    rng = random.Random(9)
    rows = list({(g, m) for m in range(150) for g in ["all", *rng.sample("abcdefgh", 2)] if g != "all" or m % 10})
    frame = spark.createDataFrame(rows, "g string, m int")
    plain = {}
    for g in {g for g, _ in rows}:
        ms = sorted(m for x, m in rows if x == g)
        for i, a in enumerate(ms):
            for b in ms[i + 1 :]:
                plain[a, b] = plain.get((a, b), 0) + 1
    for block in (7, 1000):
        got = {(r.left_id, r.right_id): r.n for r in relational.co_members(frame, "g", "m", "n", block=block).collect()}
        assert got == plain
    weights = {r.m: r.weight for r in relational.member_weights(frame, "g", "m").collect()}
    assert weights == {m: sum(n for pair, n in plain.items() if m in pair) for m in {m for _, m in rows}}


def test_network_totals_need_no_pairs(spark):
    from claimloom.plans import authorship

    rng = random.Random(10)
    people = [(f"p{i}", i, rng.sample(["Writing", "Software", "Data", "Review"], rng.randrange(3))) for i in range(60)]
    sections = [(f"p{rng.randrange(60)}", f"s{rng.randrange(4)}") for _ in range(70)]
    for some in (people, people[:1], people[:2], []):
        a, b = spark.createDataFrame(some, "person string, ord int, roles array<string>"), spark.createDataFrame(sections, "person string, section string")
        edges = authorship.network(a, b, block=5).cache()
        nodes, stats = authorship.network_totals(a, b, block=5)
        assert sorted(map(tuple, nodes.collect())) == sorted(map(tuple, authorship.node_totals(edges).select("ord", "weight", "n_links").collect()))
        want, got = authorship.network_stats(a, edges).first(), stats.first()
        assert (got.mean_roles, got.n_links, got.weight) == (want.mean_roles, want.n_links, want.weight)
        assert want.weight is None or got.strongest == want.strongest
        edges.unpersist()


NOISY = "  A “b”—c­ ﬁ\n\t x ¨y ﷺ … ‘it’s’ 2− 3\u00a0\u2003end.  "


def test_normal_form_keeps_places():
    from claimloom.operators import anchors

    for text in [NOISY, "", " ", "plain", "a  b", NOISY * 3, "\U0001f600 \u00ad x"]:
        form, starts, ends = anchors.normalised(text)
        plain, at, upto = [], [], []
        for i, c in enumerate(text):
            for k in anchors._plain(c):
                if k == " " and plain and plain[-1] == " ":
                    upto[-1] = i + 1
                    continue
                plain.append(k)
                at.append(i)
                upto.append(i + 1)
        assert (form, list(starts), list(ends)) == ("".join(plain), at, upto)


def test_many_quotes_of_one_source(spark, monkeypatch):
    from claimloom.functions import text as tx
    from claimloom.operators import anchors

    rng = random.Random(12)
    texts = {"a": " ".join(rng.choice(["cells “grow”", "naïve — so", "it’s", "ﬁne", "x"]) for _ in range(400)), "b": NOISY, "c": "", "d": "aXaaa"}
    quotes = [("b", '"b"-c', "A", "fi"), ("b", "it's", "", ""), ("b", "END.", "", ""), ("d", "aa", "", ""), ("d", "X", "a", "a"), ("d", "a", "", "X"), ("c", "x", "", ""), ("b", " ", "", ""), ("b", None, None, None), ("gone", "x", "", ""), ("d", "aXaaa", None, None)]
    for _ in range(600):
        i, j = sorted(rng.sample(range(len(texts["a"])), 2))
        quotes.append(("a", texts["a"][i : min(j, i + 30)].replace("“", '"'), texts["a"][max(0, i - 6) : i] if rng.random() < 0.5 else "", ""))
    rows = [(s, str(i), e, p, x) for i, (s, e, p, x) in enumerate(quotes)]
    found = anchors.anchored_quotes(spark.createDataFrame(rows, "source string, ident string, exact string, prefix string, suffix string"), spark.createDataFrame(list(texts.items()), "source string, text string"), block=50)
    got = {r.ident: (r.start, r.end) if r.n == 1 else None for r in found.collect()}
    want = {str(i): tx.find_unique(texts[s], e or "", p or "", x or "") for i, (s, e, p, x) in enumerate(quotes) if s in texts}
    assert got == want and sum(x is not None for x in want.values()) > 100


def test_trees_of_unknown_depth(spark):
    import json

    from claimloom.operators import trees

    rng = random.Random(13)

    def grow(depth):
        node = {"type": rng.choice(["paragraph", "claim", "heading", "text"]), "value": f"v{rng.randrange(99)} "}
        return node | ({"children": [grow(depth - 1) for _ in range(rng.randrange(4))]} if depth and rng.random() < 0.8 else {})

    made = {str(i): grow(i) for i in range(12)} | {"odd": [1, 2], "number": 5, "strange": {"children": {"a": 1}}}
    chain = {"type": "end", "value": "x"}
    for _ in range(30):
        chain = {"type": "link", "children": [chain]}
    made["chain"] = chain
    texts = [(k, json.dumps(v)) for k, v in made.items()] + [("bad", "{"), ("null", None)]
    want, about, order = {}, {}, {}

    def walk(k, node, path):
        kids = node.get("children") if isinstance(node, dict) and isinstance(node.get("children"), list) else []
        want[k, path] = (len(path), node.get("type") if isinstance(node, dict) else None, node.get("value") if isinstance(node, dict) else None, len(kids))
        order.setdefault(k, []).append(path)
        anchor = None
        for i, kid in enumerate(kids):
            kind = kid.get("type")
            about[k, (*path, i)] = None if kind == "heading" else anchor
            anchor = (*path, i) if kind == "paragraph" else None if kind == "heading" else anchor
            walk(k, kid, (*path, i))

    for k, tree in made.items():
        walk(k, tree, ())
    rows = trees.tree_rows(spark.createDataFrame(texts, "id string, text string"), "id", "text")
    assert {(r.id, tuple(r.path)): (r.depth, r.kind, r.value, r.n_children) for r in rows.collect()} == want
    near = trees.sibling_before(rows, "id", F.col("kind") == "paragraph", F.col("kind") == "heading", "about")
    assert {(r.id, tuple(r.path)): r.about and tuple(r.about) for r in near.where("depth > 0").collect()} == about
    claims = {(r.id, tuple(r.path)): r.n for r in trees.in_order(rows, "id", F.col("kind") == "claim", "n").collect()}
    assert claims == {(k, p): i + 1 for k, ps in order.items() for i, p in enumerate([p for p in ps if want[k, p][1] == "claim"])}
    said = {r.id: r.text for r in trees.text_content(rows, "id").collect()}
    assert said == {k: "".join(want[k, p][2] or "" for p in ps) for k, ps in order.items() if any(want[k, p][2] for p in ps)}
    below = {(r.id, tuple(r.under)): r.text for r in trees.text_content(rows, "id", "paragraph").collect()}
    plain = {}
    for k, ps in order.items():
        for p in ps:
            tops = [p[:n] for n in range(len(p) + 1) if want[k, p[:n]][1] == "paragraph"]
            if tops and want[k, p][2]:
                plain[k, tops[-1]] = plain.get((k, tops[-1]), "") + want[k, p][2]
    assert below == plain
    assert {r.depth: r.n for r in trees.widths(rows.where("id = 'chain'")).collect()} == dict.fromkeys(range(31), 1)
    assert trees.tree_rows(spark.createDataFrame([], "id string, text string"), "id", "text").count() == 0


def test_siblings_meet_by_document(spark):
    rows = spark.createDataFrame([(1, [0, i], k) for i, k in enumerate("phcpc")] + [(1, [1, 0], "c"), (1, [], "p")], "k int, path array<int>, kind string")
    near = trees.sibling_before(rows, "k", F.col("kind") == "p", F.col("kind") == "h", "about")
    plan = near._jdf.queryExecution().executedPlan().toString()
    told = {tuple(r.path): r.about for r in near.collect()}
    assert told == {(): None, (0, 0): None, (0, 1): None, (0, 2): None, (0, 3): None, (0, 4): [0, 3], (1, 0): None}
    assert plan.count("Exchange") == 1 and "rangepartitioning" not in plan
