"""Manuscript and record checks on small tables."""

import random
import re

from pyspark.sql import functions as F

from claimloom.plans import manuscript as ms

TEXT = """# 1. Intro

It inhibits growth. Another line. See {cite:p}`k1, k2`.
```
code robust
```
:::{note}
:name: robust
robust inside
:::
robust `robust` text
## Plain
text"""


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_lines_and_contexts(spark):
    rows = ms.lines(frame(spark, [("a", TEXT)], "file string, text string"))
    context = ms.citation_contexts(rows, 1).collect()
    assert sorted(r.cite_key for r in context) == ["k1", "k2"] and len(context[0].context) == 3


def plain_mask(text, named="dropdown"):
    """The mask line by line: a fence's own mark, directives that nest, and a directive to be told apart."""
    out, fence, open_names = [], None, []
    for line in text.splitlines():
        mark = re.match(r"`{3,}|~{3,}", line)
        depth = len(open_names)
        if fence is not None:
            out.append((True, True, named in open_names))
            if line.startswith(fence):
                fence = None
        elif mark:
            fence = mark.group()
            out.append((True, True, named in open_names))
        elif found := re.match(r":::\{([a-z]+)\}", line):
            open_names.append(found.group(1))
            out.append((False, True, named in open_names))
        elif depth and re.match(r":::\s*$", line):
            out.append((False, True, named in open_names))
            open_names.pop()
        else:
            out.append((False, depth > 0, named in open_names))
    return out


MASKED = {
    "own marks": "a\n```py\n~~~\n# x\n```\nb\n~~~\n```\n:::{note}\n~~~~\nc",
    "longer marks": "````\n```\nx\n````\ny\n```\nz\n``` tail\nw",
    "never closed": "x\n~~~\ny\n:::\n```",
    "nested": ":::{note}\n:::{dropdown} t\n:::{tip}\nx\n:::\ny\n:::\nz\n:::\nw\n:::\nv",
    "no directives": "::: {note}\n:::{trust-claim}\n:::\n :::{note}\nx\n:::{note}extra\ny\n:::   \nz",
    "fence within": ":::{dropdown} a\n```\n:::\n```\nx\n:::\ny",
    "ends": "",
    "one line": "# H",
    "only a fence": "```",
    "blank": "\n\n",
    "other line ends": "a\r\n```\rb\x0c```\u2028c",
}


def test_masks_of_fences_and_directives(spark):
    rng = random.Random(4)
    texts = MASKED | {f"random {i}": "\n".join(rng.choice(["```", "````", "~~~", "~~~x", ":::{note}", ":::{dropdown}", ":::", "text", "# h", ""]) for _ in range(rng.randrange(1, 40))) for i in range(60)}
    got = {}
    for r in ms.masked_lines(frame(spark, list(texts.items()), "file string, text string")).orderBy("file", "line_no").collect():
        got.setdefault(r.file, []).append((r.line_no, r.line, (r.in_fence, r.masked, r.in_named)))
    for name, text in texts.items():
        lines = got.get(name, [])
        assert [x[:2] for x in lines] == list(enumerate(text.splitlines(), 1)), name
        assert [x[2] for x in lines] == plain_mask(text), name


def test_terms_in_prose(spark):
    text = "Robust (robust) `robust`\n    robust code\n:::{note} robust\n:robust:\n:opt: robust\n  ```\nrobust\n```\nrobustness a.b axb\n~~~\nrobust\n~~~"
    texts = frame(spark, [("a", text)], "file string, text string")
    assert sorted((r.line_no, r.term) for r in ms.prose_terms(texts, ["robust", "a.b", "absent"]).collect()) == [(1, "robust")] * 3 + [(5, "robust"), (9, "a.b"), (11, "robust")]
    assert ms.prose_terms(texts, ["robust"], any_case=False).where("line_no = 1").count() == 2
    assert ms.prose_terms(texts.where("false"), ["robust"]).count() == 0


HEADINGS = {
    "wrapped.md": ("# One\norphan", {(1, "WRAPPED_HEADING")}),
    "after.md": ("# A\n:name: x\n# B\n- x\n# C\n\ntext\n# D\n  * x\n# E\n1. x\n# F\n```\ncode\n```", set()),
    "masked.md": ("# A\n\n```\n# 1. code\n```\n:::{note}\n# 2. x\nwrapped\n:::\n", set()),
    "next.md": ("# A\n:::{note}\n:::", set()),
    "number.md": ("# A\n\n### 2.1 Part\n", {(3, "MANUAL_NUMBER_PREFIX")}),
    "spaces.md": ("# A\n\n### 2.  Part\n", {(3, "MANUAL_NUMBER_PREFIX"), (3, "MULTI_SPACE_AFTER_NUMBER")}),
    "dash.md": ("# A \u2014 b\n\n## c\u2013d\n", {(1, "INCONSISTENT_DASH"), (3, "INCONSISTENT_DASH")}),
    "mixed.md": ("# A\n\n## 1 One\n\n## Two\n", {(3, "MANUAL_NUMBER_PREFIX"), (None, "MIXED_H1_H2_STYLE")}),
    "later.md": ("# A\n\n## One\n\n## 2 Two\n", {(5, "MANUAL_NUMBER_PREFIX")}),
    "year.md": ("# A\n\n## 3D cells\n####### none\n#none\n", set()),
}


def test_faults_of_headings(spark):
    found = {}
    for r in ms.heading_problems(frame(spark, [(f, t) for f, (t, _) in HEADINGS.items()], "file string, text string")).collect():
        found.setdefault(r.file, set()).add((r.line_no, r.problem))
    assert found == {f: want for f, (_, want) in HEADINGS.items() if want}
    several = [("a.md", "# A"), ("b.md", "# 1 B"), ("Methods.md", "# 2 M"), ("00_frontmatter.md", "# F"), ("c.md", "## only H2")]
    told = ms.heading_problems(frame(spark, several, "file string, text string")).where("problem = 'INCONSISTENT_ACROSS_SECTIONS'").collect()
    assert {r.file for r in told} == {"a.md", "b.md"}
    alike = ms.heading_problems(frame(spark, [several[0], *several[2:]], "file string, text string")).where("line_no is null")
    assert alike.count() == 0


def test_captions_and_hard_references(spark):
    figure = lambda options, caption: f":::{{figure}} a.png\n{options}{caption}\n:::\n"
    texts = [
        ("good", figure(":name: fig-a\n", "**Cells.** They grow.")), ("number", figure(":name: fig-a\n", "**Figure 1.2** text")), ("title", figure(":label: fig-a\n", "Cells.")), ("twice", figure(":name: fig-a\n:label: fig-a\n", "**Cells**")),
        ("two", figure(":name: fig-a\n:label: fig-b\n", "**Cells**")), ("none", figure(":width: 5\n", "**Cells**")), ("refs", "See \u00a73 and Section 2.1, sec. 4.\nSection 2\n```\n\u00a79\n```\n:::{dropdown} x\n:::{note}\n:::\nSec. 4\n:::\n:::{note}\nSec.5\n:::"),
    ]
    frame_ = frame(spark, texts, "file string, text string")
    assert {(r.file, r.problem) for r in ms.caption_problems(frame_).collect()} == {("number", "MANUAL_NUMBERING"), ("title", "NO_BOLD_TITLE"), ("twice", "REDUNDANT_NAME_LABEL"), ("none", "NO_ANCHOR")}
    assert sorted((r.line_no, r.found) for r in ms.hard_references(frame_).collect()) == [(1, "Section 2.1"), (1, "sec. 4"), (1, "\u00a73"), (12, "Sec.5")]


def test_placeholders_of_authors_and_prompts(spark):
    rows = [("a", "name: human supervisor"), ("b", "by ANONYMOUS"), ("c", "tbd"), ("d", "[name]"), ("e", "<Your Name>"), ("f", "Author 3"), ("g", "author n"), ("h", "Ann Author, 3 years"), ("i", "[PIPELINE FILLS THIS]"), ("j", "x < y > z")]
    texts = frame(spark, rows, "file string, text string")
    assert {r.file for r in ms.placeholders(texts).collect()} == set("abcdefg") | {"j"}
    assert {r.file for r in ms.placeholders(texts, prompts=True).collect()} == set("eij")


def test_sentences_and_density(spark):
    texts = frame(spark, [("a", "It inhibits growth. Then rest. So {cite:p}`k`. It gates ions."), ("b", "Kinase A targets and stabilizes it. No {cite}`x` more. End."), ("c", "It binds and regulates. Rest.")], "file string, text string")
    assert [(r.file, r.sentence_no) for r in ms.uncited_mechanisms(ms.sentences(texts)).orderBy("file").collect()] == [("a", 1), ("b", 1)]
    paragraphs = frame(spark, [("a", "{cite:p}`a, b, c`"), ("a", "{cite:p}`d, e, f, g, h`"), ("b", "none")], "file string, text string")
    assert {r.file: r.band for r in ms.citation_density(paragraphs).collect()} == {"a": "good", "b": "low"}
    block = frame(spark, [("# A\nold\n## sub\nx\n# B\nkeep",)], "t string").select(ms.replace_block(F.col("t"), "# A", "new $1\n")).first()[0]
    assert block == "# A\nnew $1\n# B\nkeep"
    assert [r.file for r in ms.page_problems(frame(spark, [("a", "see :::{note} x"), ("b", "ok")], "file string, text string")).collect()] == ["a"]
    figures = frame(spark, [(":::{figure}\n:name: fig-a\n:::\nsee {numref}`fig-b` and {ref}`it <fig-c>`",)], "text string")
    assert {(r.side, r.target) for r in ms.figure_references(figures).collect()} == {("no such figure", "fig-b"), ("no such figure", "fig-c"), ("never referred to", "fig-a")}
    assert ms.bibliography_floor(frame(spark, [("r", "@a{x}\n@b{y}")], "file string, text string"), 2, 5).first().passed


def test_keys_triples_conflicts(spark):
    bib = frame(spark, [("lee2020", "10.1/a"), ("zed2019", "10.1/b")], "cite_key string, doi string")
    forms = ["Cardin2009", "Lee2012a", "Smith2020cells", "O'Neil-Roe1999", "Müller2001", "2009", "Cardin09", "Car_din2009", "Cardin2009-b"]
    told = ms.key_map_checks(frame(spark, [(x, x) for x in forms], "cite_key string, doi string"), frame(spark, [("Lee2012a", "Leeds", 2012), ("O'Neil-Roe1999", "O’Néil Roe", 2000)], "doi string, first_author string, year int")).collect()
    assert [r.cite_key for r in told if r.form_ok] == [x for x in (r.cite_key for r in told) if x in forms[:4]] and sum(r.form_ok for r in told) == 4
    assert {r.cite_key for r in told if r.author_ok} == {"O'Neil-Roe1999"} and {r.cite_key for r in told if r.year_ok} == {"Lee2012a", "O'Neil-Roe1999"}
    cited = frame(spark, [("lee2020",), ("odd",)], "cite_key string")
    assert {(r.side, r.cite_key) for r in ms.key_problems(cited, bib).collect()} == {("cited, not in bibliography", "odd"), ("never cited", "zed2019")}
    meta = frame(spark, [("10.1/a", "Lee", 2021), ("10.1/b", "Wong", 2010)], "doi string, first_author string, year int")
    assert {r.cite_key: (r.form_ok, r.unique, r.author_ok, r.year_ok) for r in ms.key_map_checks(bib, meta).collect()} == {"lee2020": (True, True, True, True), "zed2019": (True, True, False, False)}
    assert ms.assigned_keys(frame(spark, [("10.1/a", None)], "doi string, cite_key string"), bib).first().cite_key == "lee2020"
    triples = frame(spark, [("a", 1, "lee2020", "It  is so.", 1), ("a", 2, "odd", "", 1)], "file string, line_no int, cite_key string, sentence string, batch int")
    told = {r.cite_key: tuple(r)[3:] for r in ms.triple_checks(triples, bib, frame(spark, [("a", "Yes. It is so.")], "file string, text string"), batch=1).collect()}
    assert told == {"lee2020": (True, True, True, False), "odd": (False, False, True, False)}
    conflicts = frame(spark, [("c1", "10.1/a", "10.1/b"), ("c2", "10.1/a", "10.1/z")], "conflict_id string, doi_a string, doi_b string")
    text = frame(spark, [("f", "{cite:p}`lee2020` vs {cite}`zed2019`")], "file string, text string")
    assert {r.conflict_id: r.survives for r in ms.conflict_survival(conflicts, bib, text).collect()} == {"c1": True, "c2": False}
    gates = [tuple(ms.survival_gate(frame(spark, [(x,) for x in xs], "survives boolean")).first()) for xs in ([True, False], [True, False, False], [])]
    assert gates == [(2, 1, 0.5, True), (3, 1, 0.3333, False), (0, 0, None, True)]
    names = lambda c, xs: frame(spark, [(x,) for x in xs], f"{c} string")
    assert [r.surname for r in ms.contaminated_authors(names("word", ["Lee", "zed", "house"]), names("surname", ["lee"]), names("surname", ["Lee", "Zed"])).collect()] == ["zed"]
    assert {(r.side, r.target) for r in ms.target_problems(names("target", ["a", "b"]), names("target", ["b", "c"])).collect()} == {("missing", "a"), ("unlinked", "c")}


def test_records_phases_gates(spark):
    png = bytes.fromhex(ms.PNG)
    good = [("a.png", png + b"x"), ("a.tex", b"\n  % note\n"), ("b.tex", b"\\documentclass"), ("a.bib", b"x @misc{a}"), ("a.md", b"\n# T"), ("b.MD", b"---\n"), ("c.pdf", b"<html>"), ("noext", b"")]
    bad = [("c.png", png[:7]), ("d.png", b"\x89PNG...."), ("c.tex", b"text"), ("d.tex", b""), ("b.bib", b"@book{a}"), ("c.md", b"text\n# T"), ("d.md", b"\n")]
    files = frame(spark, [(p, bytearray(c)) for p, c in good + bad], "path string, content binary")
    assert sorted(r.path for r in ms.signature_problems(files).collect()) == sorted(p for p, _ in bad)
    records = frame(spark, [("fulltext", "<body>" + "x" * 20000), ("fulltext", "x"), ("abstract_only", "x")], "text_access string, raw string")
    assert ms.honest_fulltext(records).count() == 1
    findings = frame(spark, [(1, "d", "s", "g", 1, "c1"), (1, "e", "s", "g", 2, "c1"), (2, "d", "s", "h", 3, "c2")], "section int, doi string, claim_source_sentence string, group string, finding_id int, cluster string")
    assert sorted(r.problem for r in ms.uniform_sentences(findings).collect()) == ["repeated in section", "same across sections"]
    assert [r.doi for r in ms.continuation(findings, frame(spark, [("d",)], "doi string")).collect()] == ["e"]
    assert [r.page for r in ms.budget_batches(findings, "group", "finding_id", 1).orderBy("finding_id").collect()] == [1, 2, 1]
    plans = frame(spark, [(1, "p1", "t1"), (2, "p2", "t2")], "section int, plan string, thesis string")
    assert [(r.thesis_before, r.thesis_after) for r in ms.neighbours(plans).orderBy("section").collect()] == [(None, "t2"), ("t1", None)]
    view = lambda *xs: frame(spark, list(xs), "section int, cluster string")
    assert [(r.problem, r.section) for r in ms.mapping_problems({"a": view((1, "x")), "b": view((1, "x"), (2, "y"))}).collect()] == [("b but not a", 2)]
    ledger = frame(spark, [(1, "a", "complete"), (2, "b", "running"), (3, "c", "running"), (4, "d", "pending")], "phase_no int, phase string, status string")
    assert [r.phase for r in ms.phase_problems(ledger).collect()] == ["c"]
    frames = frame(spark, [("x", "ok", "2025-01-01T00:00:00Z"), ("x", "ok", "2025-01-01T01:30:00Z"), ("y", "bad", "2025-01-01T00:00:00Z")], "agent string, status string, at string")
    assert [(r.n, r.hours) for r in ms.frame_report(frames).collect()] == [(2, 1.5), (1, 0.0)]
    targets = frame(spark, [("c1", 2), ("c2", 2)], "cluster string, target int")
    assert {r.grain: r.passed for r in ms.target_gates(findings, targets).collect()} == {"c1": True, "c2": False, "overall": False}
    assert {r.group: r.passed for r in ms.retention(findings, findings.where("finding_id <> 2")).collect()} == {"g": False, "h": True}
    kinds = frame(spark, [(1, "A"), (1, "A"), (2, "B")], "section int, category string")
    assert {r.section: (r.A, r.B) for r in ms.category_histogram(kinds, ["A", "B"]).collect()} == {1: (2, 0), 2: (0, 1)}
    assert [r.finding_id for r in ms.top_by(findings, ["group"], "finding_id", "doi", 1).orderBy("group").collect()] == [2, 3]
    fixes = frame(spark, [("a", 1), ("a", 9)], "file string, offset int")
    assert [r.offset for r in ms.apply_order(fixes).collect()] == [9, 1]
    claims = frame(spark, [("c1", "empirical", "f", 1), ("c2", "definition", "f", 2), ("c3", "empirical", "f", 3)], "claim_id string, claim_type string, source_file string, paragraph_index int")
    assert [r.claim_id for r in ms.untagged_claims(claims, frame(spark, [("c1",)], "claim_id string"), ["empirical"]).collect()] == ["c3"]
    papers = frame(spark, [("f", "EU", "x"), ("f", "US", "x"), ("g", "EU", "x")], "comparison_id string, region string, level string")
    assert {r.comparison_id: r.verdict for r in ms.comparability(papers, ["region"], ["level"]).collect()} == {"f": "CAVEAT", "g": "PASS"}


def test_lines_end_as_before_where_a_text_is_cut(spark):
    texts = [("a", "x\r\n:::{dropdown} y\r\nin\r\n:::  \r\nout\n\r"), ("b", ""), ("c", None), ("d", "\n"), ("e", "```\nq\u2028~~~\x0b````\n# h"), ("f", ":::\n\n```\r\n\r\n```")]
    frame = spark.createDataFrame(texts, "file string, text string")
    got = [(r.file, r.line_no, r.line, r.in_fence, r.depth, r.masked, r.in_named, r.next, r.next_masked) for r in ms.masked_lines(frame).collect()]
    no, fence = (False, 0, False, False), (True, 0, True, False)
    told = {
        "a": [("x", *no), (":::{dropdown} y", False, 1, True, True), ("in", False, 1, True, True), (":::  ", False, 1, True, True), ("out", *no), ("", *no)], "d": [("", *no)],
        "e": [("```", *fence), ("q", *fence), ("~~~", *fence), ("````", *fence), ("# h", *no)], "f": [(":::", *no), ("", *no), ("```", *fence), ("", *fence), ("```", *fence)],
    }
    expected = [(f, i + 1, *x, *((xs[i + 1][0], xs[i + 1][3]) if i + 1 < len(xs) else (None, False))) for f, xs in told.items() for i, x in enumerate(xs)]
    assert sorted(got, key=str) == sorted(expected, key=str)
    terms = ms.prose_terms(spark.createDataFrame([("a", "k\n  ``` \nk\n```\r\nk k\n:k:\n: k")], "file string, text string"), ["k"])
    assert sorted((r.line_no, r.term) for r in terms.collect()) == [(1, "k"), (5, "k"), (5, "k"), (7, "k")]


def test_pieces_are_cut_once(spark):
    plan = ms.masked_lines(spark.createDataFrame([("a", "x")], "file string, text string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2  # into pieces, and a piece into lines
