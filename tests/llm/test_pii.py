"""Personal-data spans against plain regexes, and contexts that lead to unseen identifiers."""

import hashlib
import random
import re

from claimloom.llm import pii

SCHEMA = "text string, doc_id bigint, base string, found string, kind string"


def brute(text):
    text, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        doubled = sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(digits[::-1]))
        if 12 <= len(digits) <= 19 and doubled % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.findall("[0-9]", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def corpus():
    rng = random.Random(6)
    bits = ["a.b@c.de", "x@y.com_z@w.org", "@", "a@", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.02.3.4", "4111 1111 1111 1111", "4111111111111112", "4111-1111-1111-1111", "+1 (555) 555-1234", "+49 30 1234567 ", "+1", " ", "  ", "-", ".", "é日", "word ", "7", "12", "\n", "%", "_", "(", "\U0001f600", "٣"]
    return [None, "", "a" * 50000 + "@" * 300, "9" * 5000, "1." * 3000, *["".join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(1500)]]


def test_base_spans_equal_plain_regexes():
    for text in corpus()[1:]:
        assert pii.base_spans(text) == brute(text), text


def test_query_columns(spark):
    texts = corpus()[:200]
    docs = spark.createDataFrame([(t, i, "", "", "") for i, t in enumerate(texts)], SCHEMA)
    rows = pii.digest(pii.find_pii(docs)).collect()
    assert sorted(r.doc_id for r in rows) == list(range(200))
    for r in rows:
        base = brute(texts[r.doc_id])
        listed = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert ",".join(s for s in r.spans.split(",") if not s.startswith("ctx_")) == listed


def test_contexts_find_unseen_identifiers(spark):
    rng = random.Random(8)
    seen = [f"please call +1 555 {rng.randint(100, 999)} {rng.randint(1000, 9999)} today or never" for _ in range(40)]
    other = [f"chapter {rng.randint(10000, 99999)} begins here" for _ in range(40)]
    docs = spark.createDataFrame([(t, i, "", "", "") for i, t in enumerate([*seen, *other, "please call 0171/5556677x today", "please call home today", "do please call 0171/5556678y, she said"])], SCHEMA)
    found = {r.doc_id: r.spans for r in pii.digest(pii.find_pii(docs)).collect()}
    assert found[80] == "ctx_phone:12:25"
    assert found[82] == "ctx_phone:15:28"  # known by the words before it alone
    assert found[81] == "" and all(found[i] == "" for i in range(40, 80))


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([("a@b.c", 1, "", "", ""), ("a@b.c", 1, "", "", "")], SCHEMA)
    assert [r.n_email for r in pii.digest(pii.find_pii(docs)).collect()] == [1, 1]
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_places_and_patterns_equal_a_plain_reading():
    """Candidates and their neighbours against splitting the text before and after each place, however long its words are."""
    rng = random.Random(12)
    bits = ["jane.doe@localhost", "x9", "room 12345,", "(a.b.c)", "call", "me", "7" * 90, "q" * 300 + "1", "a@b.org", " ", "  ", "\n", "first.last", "name(at)home", "é.é.é", "word", ":", "1.2.3.4"]
    for _ in range(600):
        text = "".join(rng.choice(bits) + rng.choice(["", " ", " "]) for _ in range(rng.randint(1, 15)))
        base = pii.base_spans(text)
        got = pii.candidates(text, base)
        expected = [(s, e) for s, _, e in base]
        for m in re.finditer(r"\S+", text):
            left = len(m[0]) - len(m[0].lstrip(pii._EDGE))
            right = len(m[0]) - len(m[0].rstrip(pii._EDGE))
            a, b = m.start() + left, m.end() - right
            if b - a >= 5 and re.search(r"[0-9]|@|\(at\)|[^\W\d_]\.[^\W\d_]", m[0]) and not any(s < b and a < e for s, _, e in base):
                expected.append((a, b))
        assert [(c["start"], c["end"]) for c in got] == expected
        for c in got:
            before, after = ["^", "^", *text[: c["start"]].split()][-2:], [*text[c["end"] :].split(), "$", "$"][:2]
            x, y, z, w = (pii._short(pii.shape(v.strip(pii._EDGE))) for v in (*before, *after))
            assert c["patterns"] == [f"{y} _ {z}", f"{x} {y} _", f"_ {z} {w}"]


def test_confidences_equal_a_plain_iteration(spark):
    """The bootstrap's rounds over dictionaries."""
    rng = random.Random(3)
    rows = [(rng.choice([-1, -1, 0, 3]), f"p{rng.randint(0, 6)}", f"t{rng.randint(0, 60)}") for _ in range(400)]
    kinds = {}
    for k, p, t in rows:
        kinds[p, t] = max(kinds.get((p, t), -1), k)
    seeds = {(t, k): 1.0 for (p, t), k in kinds.items() if k >= 0}
    scores, held = dict(seeds), {}
    for _ in range(3):
        held = {}
        for p, t in kinds:
            for (u, k), s in scores.items():
                if u == t:
                    held[p, k] = held.get((p, k), 0) + s
        held = {(p, k): m / (sum(q == p for q, _ in kinds) + 2.0) for (p, k), m in held.items()}
        of = {}
        for (p, t), kind in kinds.items():
            if kind < 0:
                for (q, k), c in held.items():
                    if q == p:
                        of.setdefault((t, k), []).append(c)
        scores = seeds | {}
        listed = [(tk, s) for tk, s in seeds.items()] + [(tk, max(cs) * sum(cs) / len(cs)) for tk, cs in of.items()]
        scores = {}
        for tk, s in listed:
            if s >= 0.05:
                scores[tk] = scores.get(tk, 0) + s  # a token that is a seed in one place and none in another counts for both
    ranked = {}
    for (p, k), c in held.items():
        if c >= 0.2 and sum(q == p and kind == k for (q, _), kind in kinds.items()) >= 2:
            ranked[p] = max(ranked.get(p, (0, -1)), (c, k))
    got = {r.pattern: (r.confidence, r.found_kind) for r in pii.bootstrap(spark.createDataFrame(rows, "kind int, pattern string, token string"), 3, 0.2, 2).collect()}
    assert got.keys() == ranked.keys() and len(got) > 1
    for p, (c, k) in ranked.items():
        assert got[p][1] == k and abs(got[p][0] - c) < 1e-9
