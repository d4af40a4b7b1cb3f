"""Evidence packages: historic shapes made one, roll-ups, rates, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom.functions import text as tx
from claimloom.functions import values as vl

#: Paths under which historic records keep each part of a conflict, most specific first.
CONFLICT_PATHS = {
    "side_a": ["$.side_a.claim", "$.side_a.position", "$.side_a", "$.position_a", "$.paper_a_claim", "$.claim_a", "$.finding_a", "$.sides[0].position", "$.sides[0].claim", "$.view_a"],
    "side_b": ["$.side_b.claim", "$.side_b.position", "$.side_b", "$.position_b", "$.paper_b_claim", "$.claim_b", "$.finding_b", "$.sides[1].position", "$.sides[1].claim", "$.view_b"],
    "doi_a": ["$.side_a.doi", "$.paper_a_doi", "$.doi_a", "$.sides[0].doi", "$.papers_a[0]", "$.paper_dois[0]", "$.finding_dois[0]"],
    "doi_b": ["$.side_b.doi", "$.paper_b_doi", "$.doi_b", "$.sides[1].doi", "$.papers_b[0]", "$.paper_dois[1]", "$.finding_dois[1]"],
    "topic": ["$.topic", "$.title", "$.conflict", "$.nature_of_conflict", "$.description"],
    "resolution": ["$.resolution_status", "$.resolution", "$.status"],
}
#: Replication words that mean the same.
REPLICATION = {"independently_replicated": "replicated", "replicated": "replicated", "partially_replicated": "partial", "partial": "partial", "contested": "contested", "conflicting": "contested", "unreplicated": "single_study", "single_study": "single_study", "single": "single_study", "unknown": "unknown"}


def first_path(json: Column, paths: list[str]) -> Column:
    """The first path that holds something; null and the empty text don't."""
    return F.coalesce(*[F.nullif(F.get_json_object(json, p), F.lit("")) for p in paths])


def conflicts(rows: DataFrame, json: str = "conflict") -> DataFrame:
    """One shape of all historic ones; DOIs are also found within the sides' text."""
    out = rows
    for name, paths in CONFLICT_PATHS.items():
        out = out.withColumn(name, first_path(F.col(json), paths))
    for side in "ab":
        out = out.withColumn(f"doi_{side}", F.lower(F.coalesce(F.col(f"doi_{side}"), F.nullif(tx.extract_doi(F.coalesce(f"side_{side}", F.lit(""))), F.lit("")))))
    return out.fillna("—", ["side_a", "side_b", "topic"]).fillna("unresolved", ["resolution"])


def keyed_papers(json: Column, side: int) -> Column:
    """DOIs of the first (``side`` 0) or second (1) list whose key begins with ``papers_``, in the record's order of keys."""
    keys = F.filter(F.json_object_keys(json), lambda k: k.startswith("papers_"))
    one = F.get(keys, side)
    listed = F.get(F.map_values(F.map_filter(F.from_json(json, "map<string,string>"), lambda k, _: k == one)), 0)
    entries = F.from_json(listed, "array<string>")
    doi = F.transform(entries, lambda p: F.coalesce(F.get_json_object(p, "$.doi"), F.when(~p.startswith("{"), p)))
    return F.array_join(F.filter(doi, lambda d: F.coalesce(d != "", F.lit(False))), ", ")


#: Names that figure records use for one field, the first that holds something counts.
FIGURE_NAMES = ["comparison_name", "title", "comparison_title", "comparison_id", "figure_id"]
HOMOGENEITY = [("scope_region_uniform", "Region scope varies"), ("scope_population_uniform", "Population scope varies"), ("taxonomic_level_uniform", "Taxonomic level varies"), ("n_definition_uniform", "Sample definition varies")]


def homogeneity_text(check: Column) -> Column:
    """One line from the check's flags and caveats; a check that is plain text stands as it is."""
    flags = [F.when(F.get_json_object(check, f"$.{k}") == "false", F.lit(said)) for k, said in HOMOGENEITY]
    caveats = F.get_json_object(check, "$.caveats")
    listed = F.when(caveats.startswith("["), F.from_json(caveats, "array<string>")).when(caveats != "", F.array(caveats))
    parts = F.concat(F.array_compact(F.array(*flags)), F.coalesce(listed, F.array().cast("array<string>")))
    told = F.array_join(parts, "; ")
    return F.when(check.isNull(), "").when(~check.startswith("{"), check).when(told == "", "No issues noted").otherwise(told)


def figures(rows: DataFrame, json: str = "figure") -> DataFrame:
    """Figure records (JSON text) in one shape; of papers with one key (cite key, else DOI) the first counts, papers with neither go."""
    path = lambda *names: first_path(F.col(json), [f"$.{n}" for n in names])
    text = lambda c: F.coalesce(c, F.lit(""))
    paper = "array<struct<doi:string,cite_key:string,citeKey:string,value:string,value_source_sentence:string,metric:string,study_system:string,method:string,condition:string>>"
    given = F.coalesce(F.from_json(F.get_json_object(json, "$.papers"), paper), F.array().cast(paper))
    named = F.transform(given, lambda p: F.struct(
        text(p["doi"]).alias("doi"), F.coalesce(F.nullif(p["cite_key"], F.lit("")), p["citeKey"], F.lit("")).alias("cite_key"), F.when(p["value"].isin("None", "null"), "").otherwise(text(p["value"])).alias("value"),
        text(p["value_source_sentence"]).alias("value_source"), text(p["metric"]).alias("metric"), text(p["study_system"]).alias("system"), text(p["method"]).alias("method"), text(p["condition"]).alias("condition"),
    ))
    key = lambda p: F.coalesce(F.nullif(p["cite_key"], F.lit("")), p["doi"])
    out = rows.select(
        "*", F.coalesce(path(*FIGURE_NAMES), F.lit("—")).alias("name"), text(path("what_it_reveals", "description")).alias("reveals"), F.coalesce(path("suggested_plot_type", "comparison_type"), F.lit("—")).alias("plot_type"),
        named.alias("_papers"), homogeneity_text(F.get_json_object(json, "$.homogeneity_check")).alias("homogeneity"),
        *[text(path(a)).alias(b) for a, b in (("section", "section"), ("x_axis", "x_axis"), ("y_axis", "y_axis"), ("scope_region", "region"), ("scope_population", "population"))],
    )
    keys = F.transform("_papers", key)
    first = F.filter("_papers", lambda p, i: (key(p) != "") & (F.array_position(keys, key(p)) == i + 1))
    return out.withColumn("papers", first).withColumn("n_papers", F.size("papers")).drop("_papers")


def shown_findings(findings: DataFrame, section: str | None = None, tier: str | None = None, query: str = "") -> DataFrame:
    """Findings of a section and a tier, where these are given, whose claim, DOI, study system or cite key holds the query, whatever its case."""
    rows = findings if section is None else findings.where(F.col("section").cast("string") == section)
    rows = rows if tier is None else rows.where(F.col("tier") == tier)
    q = F.lower(F.lit(query))
    hit = F.lit(False)
    for c in ("claim", "doi", "study_system", "cite_key"):
        hit = hit | F.contains(F.lower(F.coalesce(c, F.lit(""))), q)
    return rows.where(hit) if query else rows


def package_findings(grouped: DataFrame, unmatched: DataFrame, plain: DataFrame) -> DataFrame:
    """Each section's findings from its argument groups and the unmatched ones; a section that has none there gives its plain list."""
    given = grouped.unionByName(unmatched)
    return given.unionByName(plain.join(given.select("section").distinct(), "section", "left_anti"))


def parameter_problems(parameters: DataFrame) -> DataFrame:
    """``(review, problem)`` of evidence parameters that contradict one another or the prompt (review, prompt, min_papers_per_cluster, saturation_criterion, snowball_rounds)."""
    saturating = F.col("saturation_criterion").isNotNull()
    exhaustive = F.lower("prompt").rlike("saturate|cover all|every relevant")
    found = [
        (saturating & ~(F.coalesce("snowball_rounds", F.lit(0)) >= 1), "saturation needs a snowball round"),
        (exhaustive & F.col("min_papers_per_cluster").isNotNull(), "an exhaustive prompt has no minimum"),
        (exhaustive & ~saturating, "an exhaustive prompt needs a saturation criterion"),
    ]
    return parameters.select("review", F.explode(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(p)) for c, p in found]))).alias("problem"))


def status_distribution(findings: DataFrame) -> DataFrame:
    """Findings of each section by replication status, with their share."""
    n = findings.groupBy("section", replication(F.col("replication_status")).alias("replication")).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("section")), 4))


def replication(status: Column) -> Column:
    folded = F.regexp_replace(F.lower(F.trim(status)), "[ -]+", "_")
    return F.coalesce(vl.lookup(REPLICATION, folded), F.lit("unknown"))


#: Fixed value: the tier of findings that count as replicated.
REPLICATED_TIER = "independently_replicated"


def section_rollup(findings: DataFrame, found_conflicts: DataFrame, figures: DataFrame, packages: DataFrame) -> DataFrame:
    """Per section: findings, conflicts, figures, papers (stated, else total findings, else counted) and the percent in the replicated tier (by status where findings have no tier)."""
    replicated = F.coalesce(F.col("tier") == REPLICATED_TIER, F.lit(False)) if "tier" in findings.columns else replication(F.col("replication_status")) == "replicated"
    n = findings.groupBy("section").agg(F.count("*").alias("n_findings"), F.count_distinct("doi").alias("n_dois"), F.avg(replicated.cast("int")).alias("r"))
    c = found_conflicts.groupBy("section").agg(F.count("*").alias("n_conflicts"))
    f = figures.groupBy("section").agg(F.count("*").alias("n_figures"))
    rows = packages.select("section", "unique_papers", "total_findings").join(n, "section", "left").join(c, "section", "left").join(f, "section", "left").fillna(0, ["n_findings", "n_conflicts", "n_figures", "n_dois"])
    papers = F.coalesce(F.nullif("unique_papers", F.lit(0)), F.nullif("total_findings", F.lit(0)), F.col("n_findings"))
    return rows.select("section", papers.cast("bigint").alias("n_papers"), "n_findings", "n_conflicts", "n_figures", F.round(100 * F.coalesce("r", F.lit(0.0)), 1).alias("replicated_percent"))


def argument_members(groups: DataFrame, findings: DataFrame) -> DataFrame:
    """Keys of ``argument_groups`` (section, group_id, supporting_findings, counter_findings) resolved against findings."""
    side = lambda c, name: groups.select("section", "group_id", F.lit(name).alias("side"), F.explode(c).alias("cite_key"))
    keys = side("supporting_findings", "supporting").unionByName(side("counter_findings", "counter"))
    return keys.join(findings.select("section", "cite_key", "claim", "doi"), ["section", "cite_key"], "left").withColumn("resolved", F.col("claim").isNotNull())


def finding_checks(findings: DataFrame) -> DataFrame:
    """One boolean for each mechanical rule of a finding."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    strings = [c for c, kind in findings.dtypes if kind == "string"]
    clean = F.lit(True)
    for c in strings:
        clean = clean & F.coalesce(F.col(c) != "None", F.lit(True))
    return findings.select(
        "*",
        (F.length(text("claim_source_sentence")) > 50).alias("source_is_long"),
        (text("claim") != text("claim_source_sentence")).alias("claim_is_not_source"),
        F.col("text_access").isin("fulltext", "abstract_only").alias("access_is_known"),
        (tx.shared_content_words(text("claim"), text("claim_source_sentence")) >= 2).alias("claim_follows_source"),
        clean.alias("no_text_none"),
    )


def finding_provenance(findings: DataFrame, papers: DataFrame) -> DataFrame:
    """Findings with where their source sentence comes from: ``papers`` has (doi, title, abstract).

    The whole sentence stands in the abstract of a paper of which only that was read, and not in that of one read in full; it isn't
    the title; a cite key is there. A paper without an abstract can't prove a sentence; that of a paper read in full needs none.
    """
    rows = findings.join(papers.select("doi", F.col("title").alias("_title"), F.col("abstract").alias("_abstract")), "doi", "left")
    said = F.coalesce(F.contains("_abstract", "claim_source_sentence"), F.lit(False))
    proven = F.when(F.col("text_access") == "abstract_only", said).when(F.col("text_access") == "fulltext", ~said).otherwise(False)
    title = F.coalesce(F.trim("claim_source_sentence") == F.trim("_title"), F.lit(False))
    return rows.select(*findings.columns, proven.alias("source_is_proven"), (~title).alias("source_is_not_title"), (F.coalesce("cite_key", F.lit("")) != "").alias("has_cite_key"))


#: What a paper of the package that isn't cited may be.
COVERAGE = ["SHOULD_CITE", "WAIVED_OUT_OF_SCOPE", "WAIVED_REDUNDANT", "WAIVED_LOW_QUALITY"]


def coverage_counts(package: DataFrame, cited: DataFrame, review: DataFrame) -> DataFrame:
    """One row: papers of the package that are cited, and of each class; whether all adds up, and every uncited paper is reviewed once.

    All have ``cite_key``, ``review`` a ``classification`` too. A review of a cited paper, a second one, or a class that isn't
    known unbalances the account.
    """
    own = package.select("cite_key").distinct().join(cited.select("cite_key", F.lit(True).alias("cited")).distinct(), "cite_key", "left")
    told = review.groupBy("cite_key").agg(F.count("*").alias("n_reviews"), F.max("classification").alias("classification"))
    rows = own.join(told, "cite_key", "full")
    is_cited, of = F.col("cited").isNotNull(), lambda c: F.count_if(F.col("classification") == c).alias(c.lower())
    counts = rows.agg(
        F.count_if(is_cited).alias("cited"), *[of(c) for c in COVERAGE],
        F.coalesce(F.every((is_cited & F.col("n_reviews").isNull()) | (~is_cited & (F.coalesce("n_reviews", F.lit(0)) == 1))), F.lit(True)).alias("each_once"),
    )
    total = package.agg(F.count_distinct("cite_key").alias("in_package"))
    parts = sum((F.col(c.lower()) for c in COVERAGE), F.col("cited"))
    return counts.crossJoin(total).withColumn("balanced", (parts == F.col("in_package")) & F.col("each_once"))


def should_cite(review: DataFrame, cited: DataFrame, waivers: DataFrame) -> DataFrame:
    """Keys that the review wants cited, and that are neither cited now nor waived by the writer."""
    wanted = review.where(F.col("classification") == COVERAGE[0]).select("cite_key").distinct()
    return wanted.join(cited.select("cite_key"), "cite_key", "left_anti").join(waivers.select("cite_key"), "cite_key", "left_anti")


def rates(findings: DataFrame) -> DataFrame:
    """Shares at two grains, clusters and overall, with their gates."""
    share = lambda c: F.round(F.avg(F.coalesce(c, F.lit(False)).cast("int")), 4)
    r = findings.rollup("cluster").agg(
        F.count("*").alias("n"), F.count_distinct("doi").alias("n_dois"), share(F.col("text_access") == "fulltext").alias("fulltext"), share(F.col("effect_size").isNotNull()).alias("effect_size"),
        share(F.col("n_sample").isNotNull()).alias("sample_size"), share(replication(F.col("replication_status")) == "unknown").alias("unknown_replication"),
    )
    overall = F.col("cluster").isNull()
    passed = (F.col("fulltext") >= F.when(overall, 0.5).otherwise(0.2)) & (F.col("effect_size") >= 0.3) & (F.col("sample_size") >= 0.2) & (F.col("unknown_replication") <= 0.7)
    return r.select(F.coalesce("cluster", F.lit("overall")).alias("grain"), "n", "n_dois", "fulltext", "effect_size", "sample_size", "unknown_replication", passed.alias("passed"))


def tier_floors(counts: DataFrame, tiers: DataFrame) -> DataFrame:
    """Counts against ceil(target * share of the tier); tiers has (tier, share)."""
    floor = F.ceil(F.col("target") * F.col("share"))
    return counts.join(tiers, "tier").withColumn("floor", floor).withColumn("passed", F.col("n") >= floor)


def homogeneous(papers: DataFrame, fields: list[str]) -> DataFrame:
    """For each comparison the scope fields that aren't uniform."""
    many = [F.when(F.count_distinct(f) > 1, F.lit(f)) for f in fields]
    return papers.groupBy("comparison_id").agg(F.array_compact(F.array(*many)).alias("mixed_fields")).withColumn("homogeneous", F.size("mixed_fields") == 0)


def _authors(rows: DataFrame, name: str) -> Column:
    """Canonical forms of a list of authors; of a single one where there is no list."""
    listed = F.col(name) if name in rows.columns else F.array(F.col(name.replace("authors", "first_author")))
    plain = F.split(tx.nfkd(F.array_join(F.coalesce(listed, F.array().cast("array<string>")), "\n")), "\n")
    canonical = F.transform(plain, lambda a: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(a), tx.TEX_ACCENT, ""), r"\p{M}", ""), r"(?U)[{}\p{P}\p{S}\s]+", " ")))
    return F.filter(canonical, lambda a: a != "")


def citation_verdict(citations: DataFrame, metadata: DataFrame) -> DataFrame:
    """The ladder's first failure for each citation; both tables are joined on ``doi``.

    No record: HALLUCINATED. Title similarity (Jaccard of lower-cased words) under 0.5: CHIMERIC. Authors (``authors``, or
    ``first_author``) of whom not one has a word of a surname's length in common with the record's: CHIMERIC; lists that differ in
    any other way, names injected or left out among them: MINOR. Another year: MINOR; another journal: CHIMERIC; other volume or pages: MINOR.
    A number in ``claim`` that the record's ``abstract`` lacks: MISATTRIBUTED. Else VERIFIED. What either side lacks isn't compared.
    """
    known = metadata.select("doi", *[F.col(c).alias(f"true_{c}") for c in metadata.columns if c != "doi"])
    rows = citations.join(known, "doi", "left")
    rows = rows.withColumn("_own", _authors(rows, "authors")).withColumn("_true", _authors(rows, "true_authors"))
    words = lambda xs: F.array_distinct(F.filter(F.flatten(F.transform(xs, lambda a: F.split(a, " "))), lambda w: F.length(w) > 2))
    told = (F.size("_own") > 0) & (F.size("_true") > 0)
    differs = lambda c: (F.col(c) != F.col(f"true_{c}")) if c in citations.columns and c in metadata.columns else F.lit(False)
    journal = lambda c: tx.normalize_claim(c)
    other_journal = (journal("journal") != journal("true_journal")) if "journal" in citations.columns and "journal" in metadata.columns else F.lit(False)
    unsaid = F.lit(False)
    if "claim" in citations.columns and "abstract" in metadata.columns:
        number = r"\d+(?:\.\d+)?"
        unsaid = F.size(F.array_except(F.regexp_extract_all("claim", F.lit(number), F.lit(0)), F.regexp_extract_all("true_abstract", F.lit(number), F.lit(0)))) > 0
    verdict = vl.ladder(
        [
            (F.col("true_title").isNull(), "HALLUCINATED"),
            (tx.jaccard(tx.word_set("title"), tx.word_set("true_title")) < 0.5, "CHIMERIC"),
            (told & ~F.arrays_overlap(words(F.col("_own")), words(F.col("_true"))), "CHIMERIC"),
            (told & (F.col("_own") != F.col("_true")), "MINOR"),
            (differs("year"), "MINOR"),
            (other_journal, "CHIMERIC"),
            (differs("volume") | differs("pages"), "MINOR"),
            (unsaid, "MISATTRIBUTED"),
        ],
        "VERIFIED",
    )
    return rows.select("cite_key", "doi", verdict.alias("verdict"))


def coverage_identity(cited: DataFrame, classified: DataFrame, library: DataFrame) -> DataFrame:
    """Papers neither cited nor classified, and the counts that must add up."""
    missing = library.select("cite_key").join(cited.select("cite_key"), "cite_key", "left_anti").join(classified.select("cite_key"), "cite_key", "left_anti")
    n = lambda df, name: df.agg(F.count_distinct("cite_key").alias(name))
    return n(library, "total").crossJoin(n(cited, "cited")).crossJoin(n(classified.join(cited, "cite_key", "left_anti"), "classified")).crossJoin(n(missing, "missing")).withColumn("balanced", F.col("cited") + F.col("classified") == F.col("total"))
