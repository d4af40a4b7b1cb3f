"""Checks of manuscripts, citations and pipeline records: lines, sentences, keys, phases.

Texts are ``(file, text)``, line tables ``(file, line_no, line)``, sentence tables ``(file, sentence_no, sentence)``. Rules that
depend on the lines before are folds over a text in its row; those over sentences and lines are windows within a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom.functions import text as tx
from claimloom.functions import values as vl
from claimloom.operators.relational import both_ways
from claimloom.sources.scratch import stored

#: Verbs of a mechanism, and tokens that stand where an author's name or a prompt's text should.
MECHANISM = ["targets", "inhibits", "drives", "gates", "modulates", "mediates", "provides", "controls", "generates", "stabilizes"]
AUTHOR_PLACEHOLDERS = ["Human Supervisor", "Anonymous", "TBD", "[NAME]"]
PROMPT_PLACEHOLDERS = ["[PIPELINE FILLS THIS]", "[PIPELINE INSERTS", "[PIPELINE OVERWRITES"]
#: Template tokens in angle brackets, and numbered authors.
TEMPLATE_TOKEN, NUMBERED_AUTHOR = r"<[^<>\n]+>", r"(?i)\bAuthor\s+(?:N|\d+)\b"


def _file(order: str) -> Window:
    return Window.partitionBy("file").orderBy(order)


def lines(texts: DataFrame) -> DataFrame:
    return texts.select("file", F.posexplode(F.split("text", r"\r?\n")).alias("i", "line")).select("file", (F.col("i") + 1).alias("line_no"), "line")


def sentences(texts: DataFrame) -> DataFrame:
    parts = F.filter(F.split(tx.collapse(F.col("text")), r"(?<=[.!?])\s+(?=[A-Z])"), lambda s: s != "")
    return texts.select("file", F.posexplode(parts).alias("i", "sentence")).select("file", (F.col("i") + 1).alias("sentence_no"), "sentence")


#: Where a text's lines end, and the characters that may end one.
_LINE_END, _ENDS = r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{85}\x{2028}\x{2029}]", "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
#: What begins a fence, a directive, and what ends one.
FENCE, OPENING, CLOSING_LINE = r"^(`{3,}|~{3,})", r"^:::\{[a-z]+\}", r"^:::[ \t]*"


def _cut(text: Column, before: str) -> Column:
    """A text's pieces; each but the first begins with a line that begins with ``before``. Empty text has none."""
    return F.when(text != "", F.split(text, rf"(?<=[\n\r\x0B\x0C\x1C-\x1E\x{{85}}\x{{2028}}\x{{2029}}])(?={before})", -1))


def _split_lines(text: Column) -> Column:
    """A text's lines, of which the last keeps its line end (see :func:`_bare`); after that there is no empty line."""
    return F.split(text, rf"(?>{_LINE_END})(?!\z)", -1)


def _bare(line: Column) -> Column:
    return F.rtrim(line, F.lit(_ENDS))


def masked_lines(texts: DataFrame, named: str = "dropdown") -> DataFrame:
    """``(file, line_no, line, in_fence, depth, masked, in_named)`` of every line, and the next line with its mask.

    A fence ends at the next line that begins with its own mark (so ``~~~`` doesn't end back-ticks, nor three of them four), or
    with the text; what looks like a directive within it is none. Outside of fences directives nest. ``masked`` are fences and
    directives with the lines that bound them; ``in_named`` lines lie in a directive ``named``, at any depth.

    A text is cut before the few lines that may change the state, which is folded over these pieces in the text's row; only then
    are there rows of lines, and no line is shuffled.
    """
    state = "struct<fence:string,depth:int,named:int>"
    told_type = "struct<in_fence:boolean,depth:int,masked:boolean,in_named:boolean>"
    empty = F.lit(None).cast(f"struct<line_no:int,own:{told_type},after:{told_type},piece:string>")

    def told(fence: Column, depth: Column, masked: Column, hidden: Column) -> Column:
        return F.struct(fence.alias("in_fence"), depth.cast("int").alias("depth"), masked.alias("masked"), hidden.alias("in_named"))

    def bound(value: Column, then) -> Column:  # evaluates ``value`` once
        return F.get(F.transform(F.array(value), then), F.lit(0))

    def step(acc: Column, m: Column) -> Column:
        fence, depth, hidden = acc["s"]["fence"], acc["s"]["depth"], acc["s"]["named"]
        inside = fence != ""
        plain = ~inside & (m["fence"] == "")
        seen = F.struct(
            (~inside & (m["fence"] != "")).alias("opens"), (inside & F.startswith(m["piece"], fence)).alias("ends"), (plain & m["opening"]).alias("deeper"), (plain & ~m["opening"] & m["closing"] & (depth > 0)).alias("shallower"),
        )

        def moved(e: Column) -> Column:
            new_depth = depth + e["deeper"].cast("int") - e["shallower"].cast("int")
            new_named = F.when(e["deeper"] & m["named"] & (hidden == 0), new_depth).when(e["shallower"] & (new_depth < hidden), 0).otherwise(hidden)
            now = F.struct(F.when(e["opens"], m["fence"]).when(e["ends"], "").otherwise(fence).alias("fence"), new_depth.alias("depth"), new_named.cast("int").alias("named")).cast(state)
            return bound(now, lambda s: met(e, s))

        def met(e: Column, s: Column) -> Column:
            own = told(inside | e["opens"], F.greatest(depth, s["depth"]), inside | e["opens"] | (depth > 0) | e["deeper"], (hidden > 0) | (s["named"] > 0))
            after = told(s["fence"] != "", s["depth"], (s["fence"] != "") | (s["depth"] > 0), s["named"] > 0)
            piece = F.struct(acc["n"].alias("line_no"), own.alias("own"), after.alias("after"), m["piece"].alias("piece"))
            return F.struct(s.alias("s"), (acc["n"] + F.regexp_count(m["piece"], F.lit(_LINE_END))).alias("n"), F.concat(acc["out"], F.array(piece)).alias("out"))

        return bound(seen, moved)

    def marked(piece: Column) -> Column:
        closing = piece.rlike(rf"{CLOSING_LINE}(?:{_LINE_END}|\z)")
        return F.struct(piece.alias("piece"), F.regexp_extract(piece, FENCE, 1).alias("fence"), piece.rlike(OPENING).alias("opening"), closing.alias("closing"), piece.rlike(rf"^:::\{{(?:{named})\}}").alias("named"))

    def beside(p: Column, k: Column) -> Column:
        after = F.get("pieces", k + 1)
        return F.struct(p["line_no"].alias("line_no"), p["own"].alias("own"), p["after"].alias("after"), p["piece"].alias("piece"), F.regexp_extract(after["piece"], rf"^(.*?)(?:{_LINE_END}|\z)", 1).alias("next_line"), after["own"]["masked"].alias("next_masked"))

    begin = F.struct(F.struct(F.lit("").alias("fence"), F.lit(0).alias("depth"), F.lit(0).alias("named")).cast(state).alias("s"), F.lit(1).alias("n"), F.array_compact(F.array(empty)).alias("out"))
    rows = texts.select("file", F.transform(_cut(F.col("text"), "```|~~~|:::"), marked).alias("marks"))
    rows = rows.select("file", F.aggregate("marks", begin, step, lambda acc: acc["out"]).alias("pieces"))
    rows = rows.select("file", F.inline(F.transform("pieces", beside)))
    rows = rows.withColumn("lines", _split_lines(F.col("piece")))
    # (the outer form, since the other one would have pieces cut a second time in a filter that Spark derives from it)
    rows = rows.select("file", "line_no", "own", "after", "next_line", "next_masked", "lines", F.posexplode_outer("lines").alias("i", "line"))
    s = F.when(F.col("i") == 0, F.col("own")).otherwise(F.col("after"))
    inner = F.col("i") + 1 < F.size("lines")
    return rows.select(
        "file", (F.col("line_no") + F.col("i")).alias("line_no"), _bare(F.col("line")).alias("line"), s["in_fence"].alias("in_fence"), s["depth"].alias("depth"), s["masked"].alias("masked"), s["in_named"].alias("in_named"),
        F.when(inner, _bare(F.get("lines", F.col("i") + 1))).otherwise(F.col("next_line")).alias("next"), F.when(inner, F.col("after.masked")).otherwise(F.coalesce("next_masked", F.lit(False))).alias("next_masked"),
    )


def prose_terms(texts: DataFrame, terms: list[str], any_case: bool = True) -> DataFrame:
    """``(file, line_no, term)`` for every time a term stands in prose as a whole word, terms taken literally.

    Left out are lines between back-tick fences (of any length, indented or not), lines that begin with ``:::``, option lines
    that begin and end with a colon, and lines indented by four spaces; inline code is prose.
    """
    first = F.lit(None).cast("struct<line_no:int,piece:string>")
    add = lambda acc, p: F.struct((acc["n"] + F.regexp_count(p, F.lit(_LINE_END))).alias("n"), F.concat(acc["out"], F.array(F.struct(acc["n"].alias("line_no"), p.alias("piece")))).alias("out"))
    placed = F.aggregate(_cut(F.col("text"), " *```"), F.struct(F.lit(1).alias("n"), F.array_compact(F.array(first)).alias("out")), add, lambda acc: acc["out"])
    rows = texts.select("file", F.startswith(F.ltrim("text"), F.lit("```")).cast("int").alias("fences"), F.posexplode(placed).alias("k", "p"))
    rows = rows.select("file", (F.col("fences") + F.col("k")).alias("fences"), "p.line_no", F.posexplode(_split_lines(F.col("p.piece"))).alias("i", "line"))
    # the first line of a piece after a fence's beginning is a fence itself; what follows an odd number of them is code
    rows = rows.where("fences = 0 or (i > 0 and fences % 2 = 0)").select("file", (F.col("line_no") + F.col("i")).alias("line_no"), _bare(F.col("line")).alias("line"))
    bare = tx.collapse(F.col("line"))
    rows = rows.where(~F.startswith("line", F.lit(":::")) & ~(F.contains("line", F.lit(":")) & F.startswith(bare, F.lit(":")) & F.endswith(bare, F.lit(":"))) & ~F.startswith("line", F.lit("    ")))
    flag = "(?iu)" if any_case else ""
    word = lambda t: rf"{flag}(?U)\b" + "".join(f"\\{c}" if not c.isalnum() and c != "_" and c.isascii() else c for c in t) + r"\b"
    hits = F.flatten(F.array(*[F.array_repeat(F.lit(t), F.regexp_count("line", F.lit(word(t)))) for t in terms]))
    return rows.select("file", "line_no", F.explode(hits).alias("term"))


#: Beginnings of a line that may follow a heading at once.
AFTER_HEADING = ["#", ":", "-", "|", "`", "*", ">", "1.", "2."]
#: Files whose headings have a style of their own.
UNSTYLED = ["00_frontmatter.md", "Methods.md"]


def heading_problems(texts: DataFrame, mask: DataFrame | None = None) -> DataFrame:
    """``(file, line_no, problem)``: six faults of headings outside of code and directives.

    A heading with text on the next line, a number at its beginning, several spaces after that, a long dash; a file whose first
    H1 and first H2 differ in being numbered, and files of which not all H1s are alike (``line_no`` is null for these two).
    ``mask`` are the texts' :func:`masked_lines`, where they are there already.
    """
    head = (masked_lines(texts) if mask is None else mask).where("not masked").withColumn("level", F.length(F.regexp_extract("line", r"^(#{1,6})\s+", 1))).where("level > 0")
    head = head.withColumn("body", F.regexp_replace(F.regexp_extract("line", r"^#{1,6}\s+(.*)$", 1), r"\s+$", ""))
    after = F.regexp_replace("next", r"^\s+", "")
    wrapped = (F.coalesce(after, F.lit("")) != "") & ~F.col("next_masked")
    for x in AFTER_HEADING:
        wrapped = wrapped & ~F.startswith(after, F.lit(x))
    numbered = F.col("body").rlike(r"^\d+(\.\d+)*\.?\s+")
    found = F.array_compact(F.array(
        F.when(wrapped, "WRAPPED_HEADING"), F.when(numbered, "MANUAL_NUMBER_PREFIX"), F.when(F.col("body").rlike(r"^\d+(\.\d+)*\.?\s{2,}"), "MULTI_SPACE_AFTER_NUMBER"), F.when(F.col("body").rlike("[\u2013\u2014]"), "INCONSISTENT_DASH"),
    ))
    head = stored(head.select("file", "line_no", "level", numbered.alias("numbered"), found.alias("found")), "headings")
    lines, numbered = head.select("file", "line_no", F.explode("found").alias("problem")), F.col("numbered")
    first = lambda level: F.min_by(F.when(F.col("level") == level, numbered), F.when(F.col("level") == level, F.col("line_no")))
    files = head.groupBy("file").agg(first(1).alias("h1"), first(2).alias("h2"))
    none = F.lit(None).cast("int").alias("line_no")
    mixed = files.where("h1 <> h2").select("file", none, F.lit("MIXED_H1_H2_STYLE").alias("problem"))
    styled = files.where("h1 is not null")
    for x in UNSTYLED:
        styled = styled.where(~F.endswith("file", F.lit(x)))
    several = styled.agg((F.count_distinct("h1") > 1).alias("several"))  # one row
    return lines.unionByName(mixed).unionByName(styled.crossJoin(F.broadcast(several)).where("several").select("file", none, F.lit("INCONSISTENT_ACROSS_SECTIONS").alias("problem")))


def uncited_mechanisms(rows: DataFrame) -> DataFrame:
    """Sentences that state a mechanism with no citation (``{cite:p}`` or ``{cite:t}``) in them or beside them."""
    w = _file("sentence_no")
    cited = F.col("sentence").rlike(r"\{cite:[pt]\}")
    near = cited | F.coalesce(F.lag(cited).over(w), F.lit(False)) | F.coalesce(F.lead(cited).over(w), F.lit(False))
    marked = rows.withColumn("near", near).withColumn("stated", F.size(tx.markers("sentence", MECHANISM)) > 0)
    return marked.where("stated and not near").select("file", "sentence_no", "sentence")


def citation_contexts(rows: DataFrame, reach: int = 10) -> DataFrame:
    """For each citing line its keys and the lines around it."""
    w = _file("line_no").rowsBetween(-reach, reach)
    with_context = rows.withColumn("context", F.collect_list("line").over(w)).withColumn("keys", tx.cite_keys("line"))
    return with_context.where(F.size("keys") > 0).select("file", "line_no", F.explode("keys").alias("cite_key"), "context")


def citation_density(paragraphs: DataFrame, good: float = 4.0, least: float = 3.0) -> DataFrame:
    n = paragraphs.groupBy("file").agg((F.sum(F.size(tx.cite_keys("text"))) / F.count("*")).alias("density"))
    return n.withColumn("band", vl.ladder([(F.col("density") >= good, "good"), (F.col("density") >= least, "acceptable")], "low"))


def replace_block(text: Column, heading: str, block: str) -> Column:
    """The text below a heading, up to the next one of its level, replaced."""
    level = len(heading) - len(heading.lstrip("#"))
    return F.regexp_replace(text, rf"(?ms)^(\Q{heading}\E\s*$\n).*?(?=^#{{1,{level}}}\s|\z)", "$1" + block.replace("\\", "\\\\").replace("$", "\\$"))


#: Directives that a section's body may hold.
ALLOWED_DIRECTIVES = ["figure", "dropdown", "admonition", "warning", "evidence-explorer", "trust-claim", "human-reviews"]


def directive_whitelist(texts: DataFrame, allowed: list[str] | None = None) -> DataFrame:
    """``(file, name, n)`` of directives that aren't on the list."""
    names = texts.select("file", F.explode(F.regexp_extract_all("text", F.lit(r"(?m)^\s*:::+\{([a-z-]+)\}"), F.lit(1))).alias("name"))
    return names.where(~F.col("name").isin(allowed or ALLOWED_DIRECTIVES)).groupBy("file", "name").agg(F.count("*").alias("n"))


def stale_phrases(texts: DataFrame, phrases: list[str]) -> DataFrame:
    """``(file, phrase)`` of phrases that should be gone."""
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lower(F.lit(p))), p) for p in phrases]))
    return texts.select("file", F.lower("text").alias("low")).select("file", F.explode(held).alias("phrase"))


def surname_hits(texts: DataFrame, surname: str) -> DataFrame:
    """Files that hold a surname as a whole word, with the number of times."""
    return texts.select("file", F.regexp_count("text", F.lit(rf"(?i)(?<![A-Za-z]){surname}(?![A-Za-z])")).alias("n")).where("n > 0")


def page_problems(pages: DataFrame) -> DataFrame:
    """Built pages that show front matter or directives as text."""
    leak = F.regexp_count("text", F.lit(r"(?m)^---\s*\n(?:title|kernelspec|date):")) + F.regexp_count("text", F.lit(r":::+\{[a-z-]+\}|\{cite[^}]*\}`"))
    return pages.select("file", leak.alias("n_leaks")).where("n_leaks > 0")


def target_problems(links: DataFrame, targets: DataFrame) -> DataFrame:
    """Links without target, and targets that nothing links to; both have ``target``."""
    return both_ways(links.select("target").distinct(), targets.select("target").distinct(), ["target"], "missing", "unlinked")


def key_problems(cited: DataFrame, bibliography: DataFrame) -> DataFrame:
    """Cited keys without entry and entries never cited."""
    return both_ways(cited.select("cite_key").distinct(), bibliography.select("cite_key").distinct(), ["cite_key"], "cited, not in bibliography", "never cited")


#: Fixed value: a key is the first author's surname, a year, and a letter or word that tells keys apart; ASCII only.
KEY_FORM = r"^[A-Za-z][A-Za-z'-]*[0-9]{4}[A-Za-z]*$"


def key_map_checks(keys: DataFrame, metadata: DataFrame) -> DataFrame:
    """For each (cite_key, doi): form, uniqueness, the surname as the first author has it (ASCII letters compared), year within one."""
    w = Window.partitionBy("cite_key")
    rows = keys.withColumn("n", F.count("*").over(w)).join(metadata.select("doi", "first_author", "year"), "doi", "left")
    letters = lambda x: F.regexp_replace(F.lower(x), "[^a-z]", "")
    year = F.regexp_extract("cite_key", r"([0-9]{4})[A-Za-z]*$", 1).try_cast("int")
    own = letters(F.regexp_extract("cite_key", r"^([^0-9]*)", 1))
    author = letters(tx.ascii_fold("first_author"))
    return rows.select("cite_key", "doi", F.col("cite_key").rlike(KEY_FORM).alias("form_ok"), (F.col("n") == 1).alias("unique"), F.coalesce((own != "") & (own == author), F.lit(False)).alias("author_ok"), F.coalesce(F.abs(year - F.col("year")) <= 1, F.lit(False)).alias("year_ok"))


def assigned_keys(findings: DataFrame, key_map: DataFrame) -> DataFrame:
    return findings.drop("cite_key").join(key_map.select("doi", "cite_key"), "doi", "left")


def triple_checks(triples: DataFrame, bibliography: DataFrame, sources: DataFrame, batch: int = 18) -> DataFrame:
    """Each citation triple: in the bibliography, sentence not empty and found in its source, batch not too large."""
    sizes = triples.groupBy("batch").agg(F.count("*").alias("_n"))
    known = bibliography.select("cite_key", F.lit(True).alias("_known")).distinct()
    rows = triples.join(sizes, "batch").join(known, "cite_key", "left").join(sources.select("file", "text"), "file", "left")
    found = F.coalesce(F.contains(tx.collapse(F.col("text")), tx.collapse(F.col("sentence"))), F.lit(False))
    return rows.select("file", "line_no", "cite_key", F.col("_known").isNotNull().alias("in_bibliography"), (F.trim(F.coalesce("sentence", F.lit(""))) != "").alias("not_empty"), found.alias("in_source"), (F.col("_n") <= batch).alias("batch_ok"))


def conflict_survival(conflicts: DataFrame, key_map: DataFrame, text: DataFrame) -> DataFrame:
    """Conflicts of which both sides' papers are cited in the same file."""
    cited = text.select("file", F.explode(F.array_distinct(tx.cite_keys("text"))).alias("cite_key")).join(key_map.select("cite_key", "doi"), "cite_key").select("file", "doi")
    a, b = cited.select("file", F.col("doi").alias("doi_a")), cited.select(F.col("file").alias("file_b"), F.col("doi").alias("doi_b"))
    both = conflicts.join(a, "doi_a").join(b, "doi_b").where("file = file_b").select("conflict_id").distinct().withColumn("survives", F.lit(True))
    return conflicts.select("conflict_id").join(both, "conflict_id", "left").select("conflict_id", F.coalesce("survives", F.lit(False)).alias("survives"))


def survival_gate(survival: DataFrame, least: float = 0.5) -> DataFrame:
    """``(n, n_surviving, rate, passed)`` of all conflicts; without conflicts there is no rate, and the gate is open."""
    n = survival.agg(F.count("*").alias("n"), F.count_if("survives").alias("n_surviving"))
    rate = F.when(F.col("n") > 0, F.round(F.col("n_surviving") / F.col("n"), 4))
    return n.withColumn("rate", rate).withColumn("passed", F.coalesce(F.col("n_surviving") >= F.col("n") * least, F.lit(True)))


def contaminated_authors(prompt_words: DataFrame, metadata: DataFrame, surnames: DataFrame) -> DataFrame:
    """Surnames that stand in a prompt though no cited work has them."""
    held = prompt_words.select(F.lower("word").alias("surname")).distinct().join(surnames.select(F.lower("surname").alias("surname")), "surname", "left_semi")
    return held.join(metadata.select(F.lower("surname").alias("surname")), "surname", "left_anti")


def placeholders(texts: DataFrame, prompts: bool = False) -> DataFrame:
    """``(file, found)`` of placeholder tokens, whatever their case: those of author files, or with ``prompts`` those of prompt files; template tokens in either."""
    plain = PROMPT_PLACEHOLDERS if prompts else AUTHOR_PLACEHOLDERS
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lower(F.lit(x))), x) for x in plain]))
    texts = texts.select("file", "text", F.lower("text").alias("low"))
    matched = lambda may, pattern: F.when(may, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    more = matched(F.contains("text", F.lit("<")), TEMPLATE_TOKEN)
    found = F.concat(held, more) if prompts else F.concat(held, more, matched(F.contains("low", F.lit("author")), NUMBERED_AUTHOR))
    return texts.select("file", found.alias("found")).where(F.size("found") > 0)


def honest_fulltext(records: DataFrame) -> DataFrame:
    """Records that claim full text without a body or with too little of it."""
    return records.where("text_access = 'fulltext'").where(~((F.length("raw") > 15 * 1024) & F.contains("raw", F.lit("<body"))))


#: The first eight bytes of a PNG file; how the first line with anything on it begins; what a bibliography has.
PNG = "89504E470D0A1A0A"
FIRST_LINE = {"tex": ("%", "\\"), "md": ("#", "---")}
ENTRIES = ("@article", "@misc")


def signature_problems(files: DataFrame) -> DataFrame:
    """Files (path, content) that aren't what their extension says; other extensions have no rule."""
    extension = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    text = F.decode("content", "UTF-8")
    line = F.regexp_extract(text, r"^\s*(\S[^\r\n]*)", 1)
    begins = lambda marks: F.coalesce(*[F.when(F.startswith(line, F.lit(m)), F.lit(True)) for m in marks], F.lit(False))
    sound = F.when(extension == "png", F.hex(F.substring("content", 1, 8)) == PNG).when(extension == "bib", F.contains(text, F.lit(ENTRIES[0])) | F.contains(text, F.lit(ENTRIES[1])))
    for kind, marks in FIRST_LINE.items():
        sound = sound.when(extension == kind, begins(marks))
    return files.where(~F.coalesce(sound.otherwise(True), F.lit(False))).select("path")


def uniform_sentences(findings: DataFrame) -> DataFrame:
    """Source sentences repeated within a section, and DOIs that give one sentence to several sections."""
    inside = findings.groupBy("section", "claim_source_sentence").count().where("count > 1").select(F.lit("repeated in section").alias("problem"), "claim_source_sentence")
    across = findings.groupBy("doi", "claim_source_sentence").agg(F.count_distinct("section").alias("n")).where("n > 1").select(F.lit("same across sections").alias("problem"), "claim_source_sentence")
    return inside.unionByName(across)


def continuation(hits: DataFrame, seen: DataFrame) -> DataFrame:
    return hits.dropDuplicates(["doi"]).join(seen.select("doi"), "doi", "left_anti")


def budget_batches(rows: DataFrame, group: str, order: str, budget: int = 40) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(group).orderBy(order))
    return rows.withColumn("page", F.ceil(n / budget).cast("int"))


def neighbours(sections: DataFrame) -> DataFrame:
    """Each section's plan with the theses of the sections beside it."""
    w = Window.orderBy("section")  # a review has some dozen sections
    return sections.select("section", "plan", F.lag("thesis").over(w).alias("thesis_before"), F.lead("thesis").over(w).alias("thesis_after"))


def mapping_problems(views: dict[str, DataFrame]) -> DataFrame:
    """(section, cluster) pairs that one view has and another lacks."""
    names, out = sorted(views), None
    for a in names:
        for b in names:
            if a != b:
                lacking = views[a].select("section", "cluster").exceptAll(views[b].select("section", "cluster")).select(F.lit(f"{a} but not {b}").alias("problem"), "section", "cluster")
                out = lacking if out is None else out.unionByName(lacking)
    return out


def phase_problems(ledger: DataFrame) -> DataFrame:
    """Phases begun before the one before them was complete; (phase_no, phase, status)."""
    w = Window.orderBy("phase_no")  # some twenty phases
    return ledger.withColumn("before", F.lag("status").over(w)).where("status <> 'pending' and before is not null and before <> 'complete'").select("phase_no", "phase")


def frame_report(frames: DataFrame) -> DataFrame:
    """Frames by agent and status, with hours between the first and last."""
    at = vl.moment(F.col("at"))
    return frames.groupBy("agent", "status").agg(F.count("*").alias("n"), F.round(vl.elapsed_hours(F.min(at), F.max(at)), 4).alias("hours")).orderBy(F.desc("n"), "agent", "status")


def target_gates(findings: DataFrame, targets: DataFrame) -> DataFrame:
    """Distinct DOIs of each cluster, and of all, against targets (cluster, target); ``overall`` has the sum."""
    n = findings.rollup("cluster").agg(F.count_distinct("doi").alias("n")).select(F.coalesce("cluster", F.lit("overall")).alias("grain"), "n")
    wanted = targets.rollup("cluster").agg(F.sum("target").alias("target")).select(F.coalesce("cluster", F.lit("overall")).alias("grain"), "target")
    return wanted.join(n, "grain", "left").fillna(0, ["n"]).withColumn("passed", F.col("n") >= F.col("target"))


def retention(before: DataFrame, after: DataFrame, least: float = 0.75) -> DataFrame:
    """Share of each group's findings that curation kept."""
    a, b = (df.groupBy("group").agg(F.count_distinct("finding_id").alias(n)) for df, n in ((before, "before"), (after, "after")))
    return a.join(b, "group", "left").fillna(0, ["after"]).withColumn("share", F.round(F.col("after") / F.col("before"), 4)).withColumn("passed", F.col("share") >= least)


def category_histogram(rows: DataFrame, categories: list[str]) -> DataFrame:
    return rows.groupBy("section").pivot("category", categories).count().fillna(0)


def bibliography_floor(texts: DataFrame, entries: int, size: int) -> DataFrame:
    n = F.regexp_count("text", F.lit(r"(?m)^@[A-Za-z]+\s*\{"))
    return texts.select("file", n.alias("n_entries"), F.octet_length("text").alias("n_bytes"), ((n >= entries) & (F.octet_length("text") >= size)).alias("passed"))


def top_by(rows: DataFrame, groups: list[str], score: str, ident: str, k: int) -> DataFrame:
    """The k best rows of each group; the limit is the feature."""
    n = F.row_number().over(Window.partitionBy(*groups).orderBy(F.desc(score), ident))
    return rows.withColumn("_n", n).where(F.col("_n") <= k).drop("_n")


def apply_order(fixes: DataFrame) -> DataFrame:
    """Fixes from the end of each file to its start, so that earlier offsets stay valid."""
    return fixes.orderBy("file", F.desc("offset"))


def figure_references(texts: DataFrame) -> DataFrame:
    """Figures that no text refers to, and references without a figure."""
    labels = texts.select(F.explode(F.regexp_extract_all("text", F.lit(r"(?m)^:(?:name|label):\s*(fig-[A-Za-z0-9-]+)"), F.lit(1))).alias("target"))
    used = texts.select(F.explode(F.regexp_extract_all("text", F.lit(r"\{(?:num)?ref\}`(?:[^`<]*<)?(fig-[A-Za-z0-9-]+)"), F.lit(1))).alias("target"))
    return both_ways(used.distinct(), labels.distinct(), ["target"], "no such figure", "never referred to")


#: A figure with its options and the first line of its caption, one option, and a reference by number.
FIGURE = r"(?md):::\{figure\}[^\n]*\n((?::[^\n]+\n)+)([^\n]+)\n:::"
FIGURE_OPTION = r"(?d):([a-z]+):\s*(.*)"
HARD_REFERENCES = [r"\u00a7\d+", r"Section \d+\.\d+", r"[Ss]ec\.\s*\d+"]


def caption_problems(texts: DataFrame) -> DataFrame:
    """``(file, problem, detail)``: captions numbered by hand, without a bold lead, figures with one name given twice or none at all."""
    part = lambda n: F.regexp_extract_all("text", F.lit(FIGURE), F.lit(n))
    rows = texts.select("file", F.explode(F.arrays_zip(part(1).alias("options"), part(2).alias("caption"))).alias("f")).select("file", F.col("f.options").alias("options"), F.col("f.caption").alias("caption"))
    names, values = (F.regexp_extract_all("options", F.lit(FIGURE_OPTION), F.lit(n)) for n in (1, 2))
    rows = rows.withColumn("told", F.arrays_zip(names.alias("k"), values.alias("v")))
    value = lambda key: F.try_element_at(F.filter("told", lambda x: x["k"] == key), F.lit(-1))["v"]
    rows = rows.withColumn("name", value("name")).withColumn("label", value("label"))
    short = F.substring("caption", 1, 80)
    one = lambda c, problem, detail: F.when(c, F.struct(F.lit(problem).alias("problem"), detail.alias("detail")))
    found = F.array_compact(F.array(
        one(F.col("caption").rlike(r"^\*\*Figure\s+\d+(\.\d+)?\*\*"), "MANUAL_NUMBERING", short), one(~F.col("caption").rlike(r"^\s*\*\*"), "NO_BOLD_TITLE", short),
        one(F.col("name") == F.col("label"), "REDUNDANT_NAME_LABEL", F.col("label")), one(F.col("name").isNull() & F.col("label").isNull(), "NO_ANCHOR", short),
    ))
    return rows.select("file", F.explode(found).alias("p")).select("file", "p.*")


def hard_references(texts: DataFrame, mask: DataFrame | None = None) -> DataFrame:
    """``(file, line_no, found)`` of references to sections by number, outside of code and dropdowns; ``mask`` are their lines, masked before."""
    rows = (masked_lines(texts) if mask is None else mask).where("not in_fence and not in_named")
    return rows.select("file", "line_no", F.explode(F.flatten(F.array(*[F.regexp_extract_all("line", F.lit(x), F.lit(0)) for x in HARD_REFERENCES]))).alias("found"))


def untagged_claims(claims: DataFrame, directives: DataFrame, kinds: list[str]) -> DataFrame:
    """Claims of the given types without a directive, to be tagged."""
    return claims.where(F.col("claim_type").isin(kinds)).join(directives.select("claim_id"), "claim_id", "left_anti").select("claim_id", "source_file", "paragraph_index")


def comparability(papers: DataFrame, minor: list[str], major: list[str]) -> DataFrame:
    """The mechanical part of a comparability verdict: mixed major fields split a figure, mixed minor ones need a caveat."""
    mixed = lambda fields: sum(((F.count_distinct(f) > 1).cast("int") for f in fields), F.lit(0))
    n = papers.groupBy("comparison_id").agg(mixed(minor).alias("n_minor"), mixed(major).alias("n_major"))
    return n.withColumn("verdict", vl.ladder([(F.col("n_major") > 1, "REDESIGN"), (F.col("n_major") == 1, "SPLIT"), (F.col("n_minor") > 0, "CAVEAT")], "PASS"))
