"""Text forms, value rules, pages, manuscripts, evidence records, contributors and published forms on rows of the star tables.

Each row's text is put together from the row's values, so that the DuckDB side can say what a rule must make of it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from claimloom.functions import text as tx
from claimloom.functions import values as vl
from claimloom.operators import relational as rel
from claimloom.plans import authorship, contracts, evidence, manuscript, releases
from claimloom.plans.driver_queries import query, t
from claimloom.sources import documents, sinks
from claimloom.sources.scratch import stored


def _s(*parts):
    """Columns and texts joined."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _joined(x):
    return F.array_join(x, ",")


@query(r"""with c as (select c_custkey as k, c_name as n, c_mktsegment as m, lower(c_mktsegment) as lm from customer)
select k, n || ' ' || m || ' code' || k || ' link x alt em' as plain, regexp_replace(regexp_replace(lower(n || '!'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as token, 'v' || k as unquoted, '10.1234/ab' || k as doi, '10.1/ab' || k as radar_doi, 'k' || k || ',k2,k3' as keys,
5 as words, '&lt;a href=&quot;' || n || '&quot;&gt; &amp; &#39;' as html, 'a\|' || n || ' b' as cell, case when length(m) > 8 then substr(m, 1, 8) || '…' else m end as cut, 'A' || upper(substr(m, 1, 1)) || 'L' as initials, 'ann' as first, 'lee' as last, 'writing original draft ' || lm as role, 'Part ' || upper(substr(lm, 1, 1)) || substr(lm, 2) || ' Two' as label,
'https://x.org/v1/claims/' || n as uri, 'content/a/' || k || '.md' as path, k % 4 = 0 as relative, 'Uni' || n as folded, 'mu' || chr(776) || 'ller o ' || lm as author, k % 2 = 0 as ascii, k % 3 = 0 as balanced, (case when k % 2 = 0 then 1 else 0 end + case when k % 5 = 0 then 1 else 0 end)::int as malformed,
0.5::double as overlap, 2 as shared, round(1 / 3, 6) as jaccard, 'a,b' || k as listed, 'radar text ' || lm as hay, m || '' as section, 1 as n_markers from c""")
def q76_text_forms(spark, sf):
    """The text functions, each on a text made for it."""
    k, n, m = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
    markdown = _s(n, " **", m, "** `code", k, "` [link](http://a/", k, ") <b>x</b>{cite:p}`k", k, "` ![alt](i.png) _em_")
    third = F.pmod(k, F.lit(3))
    return t(spark, sf, "customer").select(
        k.alias("k"), tx.strip_inline_markdown(markdown).alias("plain"), tx.stable_token(_s(n, "!"), "none").alias("token"), tx.unquoted(F.when(third == 0, _s('"v', k, '"')).when(third == 1, _s("'v", k, "'")).otherwise(_s(" v", k, " "))).alias("unquoted"),
        tx.extract_doi(_s("see https://doi.org/10.1234/ab", k, "; next")).alias("doi"), tx.radar_doi(_s(" HTTPS://DX.doi.org/10.1/AB", k, " ")).alias("radar_doi"), _joined(tx.cite_keys(_s("x {cite:p}`k", k, ", k2` y {cite}`k3`"))).alias("keys"), tx.word_count(_s(" one  two ", n, "\tthree\nfour ")).alias("words"),
        tx.escape_html(_s('<a href="', n, "\"> & '")).alias("html"), tx.markdown_cell(_s("a|", n, "\nb")).alias("cell"), tx.truncate(m, 8).alias("cut"), tx.initials(_s(" ann ", m, "  lee")).alias("initials"), tx.first_name(_s(" ann ", m, " lee")).alias("first"), tx.last_name(_s("ann ", m, " lee ")).alias("last"),
        tx.fold_role(_s("Writing – Original  Draft-", m)).alias("role"), tx.title_label(_s("part_", F.lower(m), "-two")).alias("label"), tx.claim_uri(F.lit("https://x.org/"), F.lit("v1"), n).alias("uri"), tx.source_path(_s("/home/x/content/a/", k, ".md")).alias("path"),
        tx.safe_relative_path(F.element_at(F.array(F.lit("a/b.md"), F.lit("../a"), F.lit("/a"), F.lit("a\\b")), (k % 4 + 1).cast("int"))).alias("relative"), tx.ascii_fold(_s("Ünï", n)).alias("folded"), tx.canonical_author(_s('Müller, {\\"O}. ', m)).alias("author"), tx.is_ascii(F.when(k % 2 == 0, n).otherwise(_s(n, "é"))).alias("ascii"),
        tx.braces_balance(F.when(third == 0, "{a{b}}").otherwise("{a{b}")).alias("balanced"), tx.malformed_count(F.concat(F.when(k % 2 == 0, "{cite:p} x ").otherwise("{cite:p}`a` "), F.when(k % 5 == 0, "a, , b").otherwise("a, b"))).alias("malformed"), F.round(tx.title_overlap(F.lit("the cell cycle ends"), F.lit("The Cell moves on")), 6).alias("overlap"),
        tx.shared_content_words(F.lit("Cells divide with force"), _s("force makes cells divide ", F.lit("x"), " these")).cast("int").alias("_shared"), F.round(tx.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("c"))), 6).alias("jaccard"), _joined(tx.split_list(_s(" a, ,b", k, " ,"))).alias("listed"), tx.radar_text(_s("Radar—Text: ", m, "!")).alias("hay"), tx.title_label(m).alias("section"),
        F.size(tx.markers(_s("It may; MAYBE ", n, " mayor"), ["may", "might"])).alias("n_markers"),
    ).withColumn("shared", F.col("_shared") - 1).drop("_shared")


@query("""with o as (select o_orderkey as k, o_totalprice as p, o_orderpriority as pr, o_orderdate as d from orders)
select k, case when k % 5 = 0 then 'pending' when k % 101 >= 85 then 'high_trust' when k % 101 >= 70 then 'moderate_trust' when k % 101 >= 50 then 'low_trust' else 'critical_or_unreliable' end as band, case when k % 4 = 0 then 'Cited fact' when k % 4 = 1 then 'Method note' when k % 4 = 2 then 'Limitation' else 'Claim' end as class_label,
k % 25 = 0 as multiple, k % 3 <> 0 as lenient, k % 3 = 1 as strict, strftime(d, '%Y-%m-%dT%H:%M:%S.000Z') as iso, k % 7 <> 0 as ordered, ((k % 50) * 1.5)::double as hours, round((k % 9 + 1)::double / 100, 4) as percent, (k % 200)::int as last_n, case when k % 2 = 0 then 'none' else pr end as shown, k % 6 = 0 as repeats,
case when k % 2 = 0 then 1 when k % 3 = 0 then 2 else 3 end as rung, case when k % 4 = 0 then 'b,d' else 'a,c' end as chosen from o""")
def q77_value_rules(spark, sf):
    """Bands, labels, moments, thresholds, defaults and ladders."""
    k = F.col("o_orderkey")
    third = F.pmod(k, F.lit(3))
    begin = F.lit("2024-01-01T00:00:00Z").cast("timestamp")
    percent, last = vl.threshold_of(_s("<", k % 9 + 1, "% new unique in last ", k % 200))
    moment = F.when(third == 0, "not a time").when(third == 1, "2024-02-03T04:05:06+02:00").otherwise("2024-02-03 04:05")
    return t(spark, sf, "orders").select(
        k.alias("k"), vl.band_text(F.when(k % 5 != 0, k % 101)).alias("band"), vl.class_label(F.element_at(F.array(F.lit("Empirical"), F.lit("definition"), F.lit("limitation"), F.lit("other")), (k % 4 + 1).cast("int"))).alias("class_label"),
        vl.multiple_of(k, 25).alias("multiple"), vl.moment(moment).isNotNull().alias("lenient"), vl.strict_moment(moment).isNotNull().alias("strict"), vl.iso_utc(F.col("o_orderdate").cast("timestamp")).alias("iso"),
        vl.in_order(begin, F.when(k % 7 != 0, begin + F.expr("interval 1 day")), begin + F.expr("interval 2 days")).alias("ordered"), F.round(vl.elapsed_hours(begin, (F.unix_timestamp(begin) + (k % 50) * 5400).cast("timestamp")), 4).alias("hours"),
        F.round(percent, 4).alias("percent"), last.alias("last_n"), vl.or_default(F.when(k % 2 != 0, F.col("o_orderpriority")).otherwise(""), "none").alias("shown"), rel.has_repeats(F.array(F.lit(1), F.when(k % 6 == 0, 1).otherwise(2))).alias("repeats"),
        vl.ladder([(k % 2 == 0, 1), (F.lit(None).cast("boolean"), 9), (k % 3 == 0, 2)], 3).alias("rung"), _joined(vl.chosen_in_order(F.when(k % 4 == 0, F.array(F.lit("d"), F.lit("b"), F.lit("z"))).otherwise(F.array(F.lit("c"), F.lit("a"))), ["a", "b", "c", "d"])).alias("chosen"),
    )


#: Pages that one task makes.
PAGES = 10_000


def _pages(spark, sf):
    """A Markdown page for each customer."""
    k, n = F.col("c_custkey"), F.col("c_name")
    figure = F.when(k % 2 == 0, ":::{figure} a.png\n:name: fig-a\n:::\n\n").otherwise("")
    strange = F.when(k % 3 == 0, ":::{toctree}\n:::\n\n").otherwise("")
    text = _s(
        "# Title ", k, "\n\nFirst para ", n, ".\n\n:::{trust-claim}\n:claim-id: clm_x\n:claim: \"Text ", k, "\"\n:claim: 'Last ", k, "'\n:::\n\n(anchor)=\n\n## Sub: part\n*caption*\n\nSecond para with **bold** and {cite}`a", k, ", b`. It binds iron. Nothing more.\n\n```\nTODO in code kinase\n```\n\nA kinase `kinase` word, see {numref}`fig-a`.\n\n",
        figure, strange, "Last words, old phrase by Smith.\n",
    )
    rows = t(spark, sf, "customer").select("c_custkey", "c_name")
    # the keys of a million pages are one small file, which would be read by few tasks
    rows = rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), rel.parts_for(rows.count(), PAGES)))
    return rows.select(_s(k).alias("file"), text.alias("text"))


@query("""with p as (select c_custkey::varchar as file, c_custkey as k, c_name as n, (c_custkey % 2 = 0)::int as even, (c_custkey % 3 = 0)::int as third from customer),
para as (select file, unnest(['First para ' || n || '.', 'Second para with bold and . It binds iron. Nothing more.', '`` TODO in code kinase ``', 'A kinase kinase word, see {numref}fig-a.', ':::{figure} a.png :name: fig-a :::', ':::{toctree} :::', 'Last words, old phrase by Smith.']) as text, unnest([1, 2, 3, 4, 5, 5 + even, 5 + even + third]) as i, unnest([1, 1, 1, 1, even, third, 1]) as shown from p)
select file, 'heading' as kind, 'title-' || k as a, 'Title ' || k as b, 1 as i from p union all select file, 'heading', 'sub-part', 'Sub: part', 2 from p union all select file, 'directive', 'clm_x', 'Last ' || k, 0 from p
union all select file, 'paragraph', md5(text), '', i from para where shown = 1
union all select file, 'figure', (k % 2 = 0)::varchar, '', 0 from p""")
def q78_pages(spark, sf):
    """Headings, directive options, all paragraphs and figures of every page."""
    pages = _pages(spark, sf)
    none = F.lit("")
    heads = documents.headings(pages).select("file", F.lit("heading").alias("kind"), F.col("heading_id").alias("a"), F.col("title").alias("b"), F.col("level").alias("i"))
    told = documents.directives(pages).select("file", F.lit("directive").alias("kind"), F.col("options")["claim-id"].alias("a"), F.col("options")["claim"].alias("b"), F.col("ord").alias("i"))
    prose = documents.paragraphs(pages).select("file", F.lit("paragraph").alias("kind"), F.md5("text").alias("a"), none.alias("b"), F.col("paragraph_index").alias("i"))
    drawn = documents.has_figures(pages).select("file", F.lit("figure").alias("kind"), F.col("has_figures").cast("string").alias("a"), none.alias("b"), F.lit(0).alias("i"))
    return heads.unionByName(told).unionByName(prose).unionByName(drawn)


def _manuscripts(spark, sf):
    """The pages with one kind of fault at each remainder of the customer's key, and at the end a fence that back-ticks don't end."""
    k = F.col("file").cast("bigint")
    on = lambda m, text: F.when(k % m == 0, text).otherwise("")
    text = F.replace("text", F.lit("# Title "), F.concat(F.lit("# "), on(7, "1. "), F.lit("Title ")))
    more = [
        on(4, "The drug inhibits growth. Quiet words here.\n\n"), on(6, "Calm words. It gates iron. Next {cite:p}`z`.\n\n"), on(5, "## 1.  Methods \u2013 part\nOrphan words.\n\n"), F.lit("    kinase indented\n\n:::{note}\nkinase inside\n:::\n\n:::{dropdown} x\nSec. 4\n:::\n\n"),
        on(10, ":::{figure} b.png\n:name: fig-b\n:label: fig-b\n**Figure 1.2** text\n:::\n\n"), on(11, ":::{figure} c.png\n:width: 5\nplain\n:::\n\n"), on(13, "See Section 2.1 and \u00a73.\n\n"), on(8, "name: human supervisor\n\n"), on(9, "by Author 3\n\n"), F.when(k % 3 == 1, "~~~\n```\n# fenced kinase\n~~~\n").otherwise(""),
    ]
    return _pages(spark, sf).select("file", F.concat(text, F.lit("\n"), *more).alias("text"))


_MANUSCRIPT_COUNTS = {
    "term kinase": "3 * n", "term binds": "n", "term absent": "0", "WRAPPED_HEADING": "k5", "MANUAL_NUMBER_PREFIX": "k5 + k7", "MULTI_SPACE_AFTER_NUMBER": "k5", "INCONSISTENT_DASH": "k5", "MIXED_H1_H2_STYLE": "k7", "INCONSISTENT_ACROSS_SECTIONS": "case when k7 between 1 and n - 1 then n else 0 end",
    "uncited mechanism": "k4", "citation context": "2 * n + k6", "low density": "n - k6", "placeholder": "k8or9", "not allowed toctree": "k3", "stale phrase": "n", "surname": "n", "fenced lines": "3 * n + 4 * k3plus1", "in directive": "6 * n + 3 * k2 + 2 * k3 + 5 * k10 + 4 * k11", "in dropdown": "3 * n",
    "leaks": "4 * n + k2 + k3 + k6 + k10 + k11", "replaced": "n", "entries below floor": "n", "MANUAL_NUMBERING": "k10", "REDUNDANT_NAME_LABEL": "k10", "NO_BOLD_TITLE": "k11", "NO_ANCHOR": "k11", "hard reference": "2 * k13",
}


@query(f"""with n as (select count(*) as n, {', '.join(f"count(*) filter (c_custkey % {m} = 0) as k{m}" for m in (2, 3, 4, 5, 6, 7, 10, 11, 13))}, count(*) filter (c_custkey % 8 = 0 or c_custkey % 9 = 0) as k8or9, count(*) filter (c_custkey % 3 = 1) as k3plus1 from customer)
{' union all '.join(f"select '{name}' as name, ({n})::bigint as n from n" for name, n in _MANUSCRIPT_COUNTS.items())}""")
def q79_manuscript_checks(spark, sf):
    """What the manuscript checks find in all pages, counted; every kind of fault is on some of them."""
    pages = _manuscripts(spark, sf)
    lines, sentences = manuscript.lines(pages), manuscript.sentences(pages)
    mask = stored(manuscript.masked_lines(pages), "masked-lines")  # three checks read them
    swapped = pages.select(manuscript.replace_block(F.col("text"), "## Sub: part", "New.\n").alias("text")).where(F.contains("text", F.lit("## Sub: part\nNew.")) & ~F.contains("text", F.lit("Second para")))
    one = lambda name, rows: rows.select(F.lit(name).alias("name"))
    found = [
        manuscript.prose_terms(pages, ["kinase", "binds", "absent"]).select(F.concat(F.lit("term "), "term").alias("name")), manuscript.heading_problems(pages, mask).select(F.col("problem").alias("name")), manuscript.caption_problems(pages).select(F.col("problem").alias("name")), one("hard reference", manuscript.hard_references(pages, mask)),
        one("uncited mechanism", manuscript.uncited_mechanisms(sentences)), one("citation context", manuscript.citation_contexts(lines)), one("low density", manuscript.citation_density(pages).where("band = 'low'")), one("placeholder", manuscript.placeholders(pages)),
        one("not allowed toctree", manuscript.directive_whitelist(pages, [*manuscript.ALLOWED_DIRECTIVES]).where("name = 'toctree'")), one("stale phrase", manuscript.stale_phrases(pages, ["OLD phrase", "gone"])), one("surname", manuscript.surname_hits(pages, "smith")),
        mask.select(F.explode(F.array_compact(F.array(F.when(F.col("in_fence"), "fenced lines"), F.when(F.col("masked") & ~F.col("in_fence"), "in directive"), F.when(F.col("in_named"), "in dropdown")))).alias("name")),
        manuscript.page_problems(pages).select(F.explode(F.array_repeat(F.lit("leaks"), F.col("n_leaks").cast("int"))).alias("name")), one("replaced", swapped), one("entries below floor", manuscript.bibliography_floor(pages, 1, 10).where("not passed")),
    ]
    out = found[0]
    for rows in found[1:]:
        out = out.unionByName(rows)
    return rel.zero_filled_counts(out, "name", list(_MANUSCRIPT_COUNTS))


@query("""select 'k' || s_suppkey as cite_key, case when s_suppkey % 3 <> 0 then '10.1/x' || s_suppkey end as doi, 'Öz, A.;' || 'Lee ' || s_suppkey as authors from supplier""")
def q80_bibliography(spark, sf):
    """One BibTeX file for each nation, read back as entries."""
    k = F.col("s_suppkey")
    entry = _s("@article{k", k, ",\n  title = {On, {Cells} and a comma},\n  author = {Öz, A. and Lee ", k, "},\n", F.when(k % 3 != 0, _s("  doi = {10.1/X", k, "},\n")).otherwise(""), "  year = {2001}\n}\n")
    files = t(spark, sf, "supplier").groupBy("s_nationkey").agg(F.array_join(F.array_sort(F.collect_list(entry)), "\n").alias("text"))
    return documents.bibliography(files).select("cite_key", "doi", F.array_join("authors", ";").alias("authors"))


# --- evidence records ------------------------------------------------------------------------------------


def _findings(spark, sf):
    """Parts as findings: a brand is a cluster, a type's last word a section."""
    k, size = F.col("p_partkey"), F.col("p_size")
    return t(spark, sf, "part").select(
        k, F.col("p_brand").alias("cluster"), (size % 3).cast("int").alias("section"), _s("10.1/", k % 97).alias("doi"), _s("k", k).alias("cite_key"), F.when(size % 2 == 0, "fulltext").otherwise("abstract_only").alias("text_access"), F.when(size % 5 != 0, F.lit(0.5)).alias("effect_size"),
        F.when(size % 3 != 0, F.lit(10)).alias("n_sample"), F.element_at(F.array(F.lit("Independently replicated"), F.lit("single-study"), F.lit("conflicting"), F.lit("odd")), (size % 4 + 1).cast("int")).alias("replication_status"), F.when(k % 2 == 0, "core").otherwise("other").alias("tier"),
        _s("Cells divide with part ", k).alias("claim"), F.when(k % 10 == 0, _s("Cells divide with part ", k)).otherwise(_s("We saw that cells divide quickly when the part is given, number ", k)).alias("claim_source_sentence"), F.when(k % 8 == 0, "None").otherwise("mouse").alias("study_system"),
    )


@query("""with f as (select p_brand as cluster, p_partkey as k, p_size as s from part), r as (select coalesce(cluster, 'overall') as grain, count(*) as n, count(distinct k % 97) as n_dois, round(avg((s % 2 = 0)::int), 4) as fulltext, round(avg((s % 5 <> 0)::int), 4) as effect_size,
round(avg((s % 3 <> 0)::int), 4) as sample_size, round(avg((s % 4 = 3)::int), 4) as unknown_replication from f group by rollup (cluster)) select *, fulltext >= case when grain = 'overall' then 0.5 else 0.2 end and effect_size >= 0.3 and sample_size >= 0.2 and unknown_replication <= 0.7 as passed from r""")
def q81_evidence_rates(spark, sf):
    return evidence.rates(_findings(spark, sf))


@query("""with f as (select p_size % 3 as section, p_size as s from part), n as (select section, case s % 4 when 0 then 'replicated' when 1 then 'single_study' when 2 then 'contested' else 'unknown' end as replication, count(*) as n from f group by 1, 2)
select section::int as section, replication, n, round(n / sum(n) over (partition by section), 4) as share from n""")
def q82_replication(spark, sf):
    """Findings of each section by replication status."""
    return evidence.status_distribution(_findings(spark, sf))


@query("""with f as (select p_partkey as k, p_size as s from part) select 'source is short' as name, count(*) filter (k % 10 = 0) as n from f union all select 'claim is source', count(*) filter (k % 10 = 0) from f union all select 'says None', count(*) filter (k % 8 = 0) from f union all select 'follows', count(*) from f
union all select 'shown', count(*) filter (s % 3 = 1 and k % 2 = 0 and contains(k::varchar, '1')) from f union all select 'section 9', 2 union all select 'all sections', (select count(distinct s % 3) from f) + 2
union all select 'repeated sentence', 0 union all select 'cited', count(distinct k) filter (k % 2 = 0) from f union all select 'missing', count(distinct k) filter (k % 2 <> 0 and k % 3 <> 0) from f union all select 'pages', sum(ceil(n / 40))::bigint from (select count(*) as n from part group by p_brand)
union all select 'new hits', count(distinct k % 97) - count(distinct k % 97) filter (k % 97 < 10) from f""")
def q83_finding_rules(spark, sf):
    """Mechanical rules of findings, the explorer's filter, packages with a fallback, coverage, pages and continuation, counted."""
    rows = _findings(spark, sf)
    checked = evidence.finding_checks(rows)
    shown = evidence.shown_findings(rows.withColumn("doi", F.lit(None).cast("string")).withColumn("cite_key", F.lit("")), section="1", tier="core", query="1")
    extra = spark.createDataFrame([(9, "x"), (9, "y"), (0, "z")], "section int, claim string")
    grouped = rows.select("section", "claim")
    packed = evidence.package_findings(grouped, grouped.limit(0), extra)
    even = rows.where("p_partkey % 2 = 0").select("cite_key")
    coverage = evidence.coverage_identity(even, rows.where("p_partkey % 3 = 0").select("cite_key"), rows.select("cite_key"))
    found = [
        ("source is short", checked.where("not source_is_long")), ("claim is source", checked.where("not claim_is_not_source")), ("says None", checked.where("not no_text_none")), ("follows", checked.where("claim_follows_source")), ("shown", shown),
        ("section 9", packed.where("section = 9")), ("all sections", packed.select("section").distinct().unionByName(packed.where("section = 9").select("section").limit(1))), ("repeated sentence", manuscript.uniform_sentences(rows)),
        ("pages", manuscript.budget_batches(rows, "cluster", "p_partkey").select("cluster", "page").distinct()), ("new hits", manuscript.continuation(rows, rows.where("p_partkey % 97 < 10").select("doi").distinct())),
    ]
    out = coverage.select(F.explode(F.array(F.struct(F.lit("cited").alias("name"), F.col("cited").alias("n")), F.struct(F.lit("missing").alias("name"), F.col("missing").alias("n")))).alias("x")).select("x.*")
    for name, part in found:
        out = out.unionByName(part.agg(F.lit(name).alias("name"), F.count("*").alias("n")))
    return out


@query("""with p as (select p_partkey as k, p_name as n, p_size as s from part) select k, case k % 4 when 0 then 'A ' || n when 1 then 'B ' || n when 2 then 'C ' || n else '—' end as side_a, case k % 4 when 0 then '10.1/a' || k when 1 then '10.1/b' || k when 2 then '10.1000/c' || k end as doi_a, case when k % 4 < 2 then 'topic ' || k else '—' end as topic,
case when k % 4 = 3 then 'closed' else 'unresolved' end as resolution from p""")
def q84_conflicts(spark, sf):
    """Four historic shapes of conflict records made one."""
    k, n = F.col("p_partkey"), F.col("p_name")
    shape = F.pmod(k, F.lit(4))
    json = (
        F.when(shape == 0, F.to_json(F.struct(F.struct(_s("A ", n).alias("claim"), _s("10.1/A", k).alias("doi")).alias("side_a"), _s("topic ", k).alias("topic"))))
        .when(shape == 1, F.to_json(F.struct(_s("B ", n).alias("position_a"), _s("10.1/b", k).alias("paper_a_doi"), _s("topic ", k).alias("title"))))
        .when(shape == 2, F.to_json(F.struct(F.array(F.struct(_s("C ", n).alias("position"), _s("10.1000/c", k).alias("doi"))).alias("sides"))))
        .otherwise(F.to_json(F.struct(F.lit("").alias("topic"), F.lit("closed").alias("status"))))
    )
    return evidence.conflicts(t(spark, sf, "part").select(k.alias("k"), json.alias("conflict"))).select("k", "side_a", "doi_a", "topic", "resolution")


@query("""select p_partkey as k, case when p_size % 2 = 0 then p_name else 'F' || p_partkey end as name, case when p_size % 3 = 0 then 'bar' else '—' end as plot_type, 2 as n_papers, 'k1:5,10.1/y:' as papers, case p_size % 4 when 0 then 'plain' when 1 then 'Region scope varies; c1; c2' when 2 then 'No issues noted' else '' end as homogeneity, '10.5/p, 10.6/q' as side_papers from part""")
def q85_figures(spark, sf):
    """Figure records with aliased fields, repeated papers and several forms of homogeneity notes; papers under dynamic keys."""
    k, size = F.col("p_partkey"), F.col("p_size")
    papers = '[{"cite_key":"k1","value":"5"},{"citeKey":"k1","value":"6"},{"doi":"10.1/y","value":"None"},{"value":"7"}]'
    note = F.element_at(F.array(F.lit(',"homogeneity_check":"plain"'), F.lit(',"homogeneity_check":{"scope_region_uniform":false,"caveats":["c1","c2"]}'), F.lit(',"homogeneity_check":{"taxonomic_level_uniform":true}'), F.lit("")), (size % 4 + 1).cast("int"))
    json = F.concat(F.lit("{"), F.when(size % 2 == 0, _s('"title":"', F.col("p_name"), '"')).otherwise(_s('"comparison_name":"","figure_id":"F', k, '"')), F.when(size % 3 == 0, ',"comparison_type":"bar"').otherwise(""), F.lit(f',"papers":{papers}'), note, F.lit("}"))
    rows = evidence.figures(t(spark, sf, "part").select(k.alias("k"), json.alias("figure"))).select("k", "name", "plot_type", "n_papers", _joined(F.transform("papers", lambda p: F.concat_ws(":", F.coalesce(F.nullif(p["cite_key"], F.lit("")), p["doi"]), p["value"]))).alias("papers"), "homogeneity")
    record = F.lit('{"x":1,"papers_for":["10.4/o"],"papers_against":["10.5/p",{"doi":"10.6/q"}]}')
    return rows.withColumn("side_papers", evidence.keyed_papers(record, 1))


@query("""with s as (select p_brand as c, count(distinct p_size % 3) as major, count(distinct p_type) as minor, count(distinct p_partkey % 97) as n, count(*) as m, count(distinct p_partkey) filter (p_size > 10) as kept, count(distinct p_partkey) as of from part group by 1)
select c as grain, case when major > 1 then 'SPLIT' when minor > 1 then 'CAVEAT' else 'PASS' end as verdict, concat_ws(',', case when major > 1 then 'section' end, case when minor > 1 then 'container' end) as mixed, n >= 10 as target_met, round(kept / of, 4) as share, n >= ceil(10 * 0.6) as floor_met from s""")
def q86_cluster_gates(spark, sf):
    """Comparability, homogeneity, targets, retention and floors of each brand."""
    rows = t(spark, sf, "part").select(F.col("p_brand").alias("comparison_id"), (F.col("p_size") % 3).alias("section"), F.col("p_type").alias("container"), _s("10.1/", F.col("p_partkey") % 97).alias("doi"), F.col("p_partkey").alias("finding_id"), "p_size")
    verdict = manuscript.comparability(rows, ["container"], ["section"]).select(F.col("comparison_id").alias("grain"), "verdict")
    mixed = evidence.homogeneous(rows, ["section", "container"]).select(F.col("comparison_id").alias("grain"), _joined("mixed_fields").alias("mixed"))
    clusters = rows.withColumnRenamed("comparison_id", "cluster")
    targets = clusters.select("cluster").distinct().withColumn("target", F.lit(10))
    met = manuscript.target_gates(clusters, targets).select("grain", F.col("passed").alias("target_met"))
    grouped = rows.withColumnRenamed("comparison_id", "group")
    share = manuscript.retention(grouped, grouped.where("p_size > 10")).select(F.col("group").alias("grain"), "share")
    tiers = spark.createDataFrame([("a", 0.6)], "tier string, share double")
    floor = evidence.tier_floors(clusters.groupBy("cluster").agg(F.count_distinct("doi").alias("n")).withColumn("tier", F.lit("a")).withColumn("target", F.lit(10)), tiers).select(F.col("cluster").alias("grain"), F.col("passed").alias("floor_met"))
    return verdict.join(mixed, "grain").join(met, "grain").join(share, "grain").join(floor, "grain")


@query("""with c as (select c_custkey as k from customer) select 'k' || k as cite_key, case when k % 11 = 0 then 'HALLUCINATED' when k % 7 = 0 or k % 5 = 0 then 'CHIMERIC' when k % 3 = 0 or k % 13 = 0 then 'MINOR' when k % 17 = 0 then 'CHIMERIC' when k % 19 = 0 then 'MINOR' when k % 23 = 0 then 'MISATTRIBUTED' else 'VERIFIED' end as verdict,
k % 4 <> 0 as form_ok, k % 4 <> 0 as author_ok, k % 4 <> 3 as year_ok from c""")
def q87_citation_ladder(spark, sf):
    """The citation ladder's first failure, and the form, author and year of keys."""
    k = F.col("c_custkey")
    on = lambda m: k % m == 0
    rows = t(spark, sf, "customer").select(
        _s("k", k).alias("cite_key"), _s("10.1/", k).alias("doi"), F.when(on(7), "The cell story about rocks").otherwise("The cell cycle of plants").alias("title"), F.when(on(5), F.array(F.lit("Lee, K."))).when(on(3), F.array(F.lit("Muller, {J}."), F.lit("Wong, D."))).otherwise(F.array(F.lit("Muller, {J}."))).alias("authors"),
        F.when(on(13), 2000).otherwise(2001).alias("year"), F.when(on(17), "Rocks").otherwise("Cells & Plants").alias("journal"), F.when(on(19), "7").otherwise("8").alias("volume"), _s("It grew by ", F.when(on(23), "12.5").otherwise("40"), " %").alias("claim"), k,
    )
    known = rows.where("c_custkey % 11 <> 0").select("doi", F.lit("The cell cycle of PLANTS").alias("title"), F.array(F.lit("Müller J")).alias("authors"), F.lit(2001).alias("year"), F.lit("cells plants").alias("journal"), F.lit("8").alias("volume"), F.lit("Growth of 40 % was seen.").alias("abstract"))
    form = F.when(k % 4 == 0, "Bad_").when(k % 4 == 1, "Muller2001").when(k % 4 == 2, "Muller2002cells").otherwise("Muller1999b")
    keys = rows.select(form.alias("cite_key"), "doi", F.col("cite_key").alias("own"), k).withColumn("cite_key", F.when(F.col("cite_key") == "Bad_", "Bad_2001").otherwise(F.col("cite_key")))
    years = keys.select("doi", F.lit("Müller").alias("first_author"), F.lit(2001).alias("year"))
    formed = manuscript.key_map_checks(keys, years).join(keys.select("doi", "own"), "doi").select(F.col("own").alias("cite_key"), "form_ok", "author_ok", "year_ok")
    return evidence.citation_verdict(rows.drop("c_custkey"), known).select("cite_key", "verdict").join(formed, "cite_key")


# --- contributors ----------------------------------------------------------------------------------------


def _people(spark, sf):
    """Suppliers as contributors: two affiliations each, roles by nation and key."""
    k, nation = F.col("s_suppkey"), F.col("s_nationkey")
    return t(spark, sf, "supplier").select(
        _s("Ann ", F.col("s_name")).alias("person"), k.cast("int").alias("ord"), F.array(_s("n", nation), F.when(k % 2 == 0, "unknown place").otherwise(_s("n", (nation + 1) % 25))).alias("affiliations"),
        F.array(F.lit("Writing – Draft"), F.when(k % 3 == 0, "software").otherwise("Data-Curation")).alias("roles"), F.when(k % 4 != 0, _s(F.lit("20"), F.lpad((k % 20).cast("string"), 2, "0"), "-0", k % 9 + 1)).alias("joined"), F.lit(None).cast("string").alias("left"),
    )


@query("""with p as (select 'Ann ' || s_name as person, s_suppkey as k, s_nationkey as n from supplier), a as (select person, k, unnest(case when k % 2 = 0 then [x.n_name, 'unknown place'] else [x.n_name, y.n_name] end) as i, unnest([1, 2]) as j from p join nation x on x.n_nationkey = p.n join nation y on y.n_nationkey = (p.n + 1) % 25),
f as (select i, min(k * 10 + j) as f from a group by 1), n as (select i, row_number() over (order by f)::int as number, count(*) over () as n_institutions from f)
select i as institution, count(distinct person) as n_members, min(person) as first_member, any_value(n_institutions) as n_institutions, any_value(number) as number from a join n using (i) group by 1""")
def q88_institutions(spark, sf):
    """Affiliations resolved by id, their members, their count and their numbers by first appearance."""
    people = _people(spark, sf)
    places = t(spark, sf, "nation").select(_s("n", F.col("n_nationkey")).alias("id"), F.col("n_name").alias("name"))
    resolved = people.select("person", "ord").join(authorship.affiliated(people, places), "person")
    members = authorship.institutions(resolved).select("institution", F.size("members").cast("bigint").alias("n_members"), F.col("members")[0].alias("first_member"))
    return members.join(authorship.affiliation_numbers(resolved), "institution").crossJoin(authorship.institution_count(resolved))


@query("""with p as (select s_suppkey as k, s_nationkey as n from supplier), e as (select a.k as i, b.k as j, 1 + ((a.k % 3 = 0) = (b.k % 3 = 0))::int as roles, (a.n = b.n)::int as sections from p a join p b on a.k < b.k),
d as (select i as ord, roles + sections as w from e union all select j, roles + sections from e) select ord::int as ord, sum(w)::bigint as weight, count(*) as n_links from d group by 1""")
def q89_author_network(spark, sf):
    """Each contributor's links and their weight in the network of shared roles and sections."""
    people = _people(spark, sf)
    sections = people.join(t(spark, sf, "supplier").select(_s("Ann ", F.col("s_name")).alias("person"), F.col("s_nationkey").cast("string").alias("section")), "person").select("person", "section")
    return authorship.network_totals(people, sections)[0]


@query("""with p as (select 'Ann ' || s_name as person, s_name as n, s_suppkey as k, case when s_suppkey % 4 <> 0 then '20' || lpad((s_suppkey % 20)::varchar, 2, '0') || '-0' || (s_suppkey % 9 + 1) else '9999' end as joined from supplier)
select person, row_number() over (order by joined, k)::int as by_joining, row_number() over (order by case k % 3 when 0 then 0 when 1 then -3 else -1 end, n, person)::int as by_level, k % 3 = 0 as programs, contains(lower(person), '1') as hit from p""")
def q90_author_orders(spark, sf):
    """Places of contributors by joining and by level in a role, role members and search."""
    from claimloom.operators.scans import numbered

    people = _people(spark, sf)
    place = lambda rows, by, name: numbered(rows.select("person", *[c.alias(f"_{i}") for i, c in enumerate(by)]), [], [f"_{i}" for i in range(len(by))], name).select("person", F.col(name).cast("int").alias(name))
    levels = people.where("ord % 3 <> 0").select("person", F.lit("data curation").alias("role"), F.when(F.col("ord") % 3 == 1, "lead").otherwise("supporting").alias("level"))
    roles = spark.createDataFrame([(0, "Software"), (1, "Funding")], "role_ord int, role string")
    programs = authorship.role_members(people, roles).where("role = 'Software'").select(F.explode("members").alias("person"), F.lit(True).alias("programs"))
    hit = authorship.matches(people.withColumn("institutions", F.array().cast("array<string>")), "1").select("person", F.lit(True).alias("hit"))
    joined = place(people, [F.coalesce("joined", F.lit("9999")), F.col("ord")], "by_joining")
    rows = joined.join(place(authorship.by_level(people, levels, "Data Curation"), [-F.col("rank"), tx.last_name("person"), F.col("person")], "by_level"), "person")
    return rows.join(programs, "person", "left").join(hit, "person", "left").fillna(False, ["programs", "hit"])


# --- published forms and contracts -----------------------------------------------------------------------


@query(r"""select c_custkey as k, '| ' || c_custkey || ' | a\|' || c_name || ' |' as line, '{"@id":"https://x.org/v1/claims/c' || c_custkey || '","@type":"Claim","text":"' || c_name || '","citation":["a","' || lower(c_mktsegment) || '"],"assessment":{"rubricVersion":"1","overallScore":' || (c_custkey % 100) || ',"label":null},"https://schema.org/citation":["https://x.org/v1/claims/c' || (c_custkey + 1) || '"],"http://purl.org/spar/cito/disputes":[],"http://purl.org/spar/cito/qualifies":[]}' as node, '{"a":null,"b":' || c_custkey || '}' as json from customer""")
def q91_published_forms(spark, sf):
    """Markdown rows, JSON-LD nodes and JSON with its nulls for every customer."""
    k, n = F.col("c_custkey"), F.col("c_name")
    rows = t(spark, sf, "customer").select(
        k.alias("k"), _s("a|", n).alias("cell"), _s("c", k).alias("claim_id"), n.alias("claim_text"), F.array(F.lower("c_mktsegment"), F.lit("a")).alias("citation_keys"),
        F.struct(F.lit("1").alias("rubric_version"), (k % 100).cast("int").alias("overall_score"), F.lit(None).cast("string").alias("trust_label")).alias("trust"), F.array(F.struct(F.lit("supports").alias("predicate"), _s("c", k + 1).alias("target_claim_id"))).alias("relations"),
    )
    nodes = sinks.nanopublications(rows, "https://x.org/", "v1")
    lines = sinks.markdown_rows(rows, ["k", "cell"]).select("k", "claim_id", "line", sinks.to_json_stable(F.struct(F.lit(None).cast("string").alias("a"), F.col("k").alias("b"))).alias("json"))
    return lines.join(nodes, "claim_id").select("k", "line", "node", "json")


_EVENT_SCHEMA = {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "minimum": 0, "maximum": 50}}, "additionalProperties": False}


@query("""select event_type, count(*) as n, count(*) filter (json_extract_string(props, '$.k') is null) as n_missing, count(*) filter (json_extract_string(props, '$.k')::bigint > 50) as n_above from events group by 1""")
def q92_contract(spark, sf):
    """Events whose properties break a JSON-Schema contract, by what is wrong."""
    rows = t(spark, sf, "events").select("event_type", contracts.problems(F.col("props"), _EVENT_SCHEMA).alias("p"))
    has = lambda word: F.count_if(F.exists("p", lambda x: F.contains(x, F.lit(word))))
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), has("missing").alias("n_missing"), has("above").alias("n_above"))


@query("""with o as (select o_orderkey as k, (select count(*) from lineitem where l_orderkey = o_orderkey) as n from orders) select k, 0 as ord, 'c' || k as cite_key, case when k % 3 = 0 then '10.1/' || k end as doi, case when k % 3 = 0 then 'own' when k % 3 = 1 then 'legacy' else 'none' end as shown from o""")
def q93_references(spark, sf):
    """Reference lists from contexts, else from bare keys; passages, else the legacy one."""
    from claimloom.sources.schemas import PASSAGE

    k = F.col("o_orderkey")
    passages = F.when(k % 3 == 0, F.array(F.named_struct(*[x for name in ("text", "passage_source", "locator", "verification_status", "verification_source", "verified_at") for x in (F.lit(name), F.lit("own"))], F.lit("supports_claim_atoms"), F.array().cast("array<string>")))).otherwise(F.array().cast(f"array<{PASSAGE}>"))
    context = F.struct(_s("c", k).alias("cite_key"), _s("10.1/", k).alias("doi"), passages.alias("passages"), F.array().cast("array<string>").alias("supports_claim_atoms"))
    rows = t(spark, sf, "orders").select(k.alias("claim_id"), F.when(k % 3 == 0, F.array(context)).otherwise(F.slice(F.array(context), 1, 0)).alias("citation_contexts"), F.array(_s("c", k)).alias("citation_keys"), context.alias("context"), F.when(k % 3 == 1, "legacy").alias("old"))
    shown = rows.select("claim_id", F.coalesce(F.get(releases.shown_passages(F.col("context"), F.col("old")), 0)["verification_status"], F.lit("none")).alias("shown"))
    return releases.references(rows).join(shown, "claim_id").select(F.col("claim_id").alias("k"), "ord", "cite_key", "doi", "shown")


@query("""with l as (select l_orderkey as k, l_partkey as p, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as i, count(*) over (partition by l_orderkey) as n from lineitem),
nodes as (select o_orderkey as k, 0 as depth, '' as path, 'root' as kind, null as value from orders
union all select k, i, '0' || repeat('/0', (i - 1)::int), 'section', null from l union all select k, i + 1, '0' || repeat('/0', (i - 1)::int) || '/1', case when p % 4 = 0 then 'heading' else 'paragraph' end, 'P' || p from l
union all select k, i + 1, '0' || repeat('/0', (i - 1)::int) || '/2', 'claim', 'c' from l)
select nodes.k, depth::int as depth, path, kind, value, case when kind = 'claim' and p % 4 <> 0 then left(path, length(path) - 1) || '1' end as about from nodes left join l on l.k = nodes.k and l.i = depth - 1 and kind = 'claim'""")
def q94_tree_rows(spark, sf):
    """Orders as trees as deep as they have lines, flattened; each claim with the paragraph before it, unless a heading is between."""
    from claimloom.operators import trees

    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    lines = t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("x"))
    leaf = lambda x: F.concat(F.lit('{"type":"'), F.when(x["l_partkey"] % 4 == 0, "heading").otherwise("paragraph"), F.lit('","value":"P'), x["l_partkey"].cast("string"), F.lit('"},{"type":"claim","value":"c"}'))
    nested = F.aggregate(F.reverse("x"), F.lit('{"type":"none"}'), lambda acc, x: F.concat(F.lit('{"type":"section","children":['), acc, F.lit(","), leaf(x), F.lit("]}")))
    text = F.concat(F.lit('{"type":"root","children":['), F.when(F.col("x").isNotNull(), nested).otherwise(""), F.lit("]}"))
    rows = trees.tree_rows(t(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.col("o_orderkey").alias("k"), text.alias("text")), "k", "text").where("kind <> 'none'")
    near = trees.sibling_before(rows, "k", F.col("kind") == "paragraph", F.col("kind") == "heading", "about")
    shown = lambda c: F.array_join(F.transform(c, lambda i: i.cast("string")), "/")
    return near.select("k", "depth", shown("path").alias("path"), "kind", "value", F.when(F.col("kind") == "claim", shown("about")).alias("about"))


@query("""with c as (select c_custkey as k, replace(replace(c_name, '\\', '\\\\'), '"', '\\"') as n, c_nationkey as nation, c_mktsegment as seg from customer),
text as (select k, '{' || chr(10) || '  "id": "c' || k || '",' || chr(10) || '  "revision": ' || (k % 5) || ',' || chr(10) || '  "who": {' || chr(10) || '    "name": "say \\"' || n || '\\"\\n",' || chr(10) || '    "nation": ' || coalesce(nation::varchar, 'null') || ',' || chr(10) || '    "known": ' || (k % 2 = 0)::varchar || chr(10) || '  },' || chr(10)
    || '  "marks": ' || case when k % 3 = 0 then '[]' else '[' || chr(10) || '    {' || chr(10) || '      "segment": "' || seg || '",' || chr(10) || '      "share": ' || case when k % 4 = 0 then (k % 7)::varchar else (k % 7)::varchar || '.5' end || chr(10) || '    },' || chr(10) || '    null' || chr(10) || '  ]' end || chr(10) || '}' || chr(10) as doc from c)
select k, sha256(doc) as sha256, length(doc)::int as n_chars from text""")
def q95_canonical_digests(spark, sf):
    """Customers as nested documents with the digest of their canonical JSON, computed where the rows are."""
    k = F.col("c_custkey")
    share = (k % 7).cast("double") + F.when(k % 4 == 0, 0.0).otherwise(0.5)
    mark = F.struct(F.col("c_mktsegment").alias("segment"), share.alias("share"))
    rows = t(spark, sf, "customer").select(
        k.alias("k"), _s("c", k).alias("id"), (k % 5).alias("revision"), F.struct(_s('say "', F.col("c_name"), '"\n').alias("name"), F.col("c_nationkey").alias("nation"), (k % 2 == 0).alias("known")).alias("who"),
        F.when(k % 3 == 0, F.slice(F.array(mark), 1, 0)).otherwise(F.array(mark, F.lit(None))).alias("marks"),
    )
    columns = ["id", "revision", "who", "marks"]
    told = sinks.canonical_digest(rows, columns, "sha256")
    text = sinks.canonical_json(F.struct(*columns), rows.select(*columns).schema)
    return told.select("k", "sha256", (F.length(text) + 1).alias("n_chars"))
