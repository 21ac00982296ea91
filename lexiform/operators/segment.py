"""Ordered blocks to clauses: headings, running boundaries, section types and their checks.

The core is windows over (doc_id, ord): one shuffle by doc_id that later steps reuse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiform.functions import predicates as pr
from lexiform.functions import roles
from lexiform.functions import text as tx
from lexiform.functions import vocabulary as v

HEADING = f"^\\s*[「【(]?\\s*第([{tx.NUMERAL}]+)\\s*条[」】)]?\\s*(.*)$"
APPENDIX = r"^\s*(附則|別紙|別表)\s*(.*)$"
APPENDICES = ["附則", "別紙", "別表"]
#: Confidence below which a boundary is doubtful.
LOW_BOUNDARY = 0.45
TITLE = r"^\s*[(（]([^)）]{1,40})[)）]"


def by_doc(*order: str) -> Window:
    return Window.partitionBy("doc_id").orderBy(*(order or ("ord",)))


def with_headings(blocks: DataFrame) -> DataFrame:
    """Adds clause_no, article, clause_title: null where a block is no heading."""
    norm = F.col("norm")
    heads, appends = F.col("heads_"), F.col("appends_")
    rows = blocks.withColumns({"heads_": pr.matches(norm, HEADING, ["条"]) & ~norm.rlike(r"条\s*(第|に|の|を|及び|から|で)"), "appends_": pr.matches(norm, APPENDIX, APPENDICES)})
    tail = F.regexp_extract(norm, HEADING, 2)
    no = F.when(heads, F.concat(F.lit("第"), F.regexp_extract(norm, HEADING, 1), F.lit("条"))).when(appends, F.regexp_extract(norm, APPENDIX, 1))
    title = F.when(heads, F.nullif(F.regexp_extract(tail, TITLE, 1), F.lit(""))).when(appends, F.nullif(F.trim(F.regexp_extract(norm, APPENDIX, 2)), F.lit("")))
    return rows.withColumn("clause_no", no).withColumn("article", F.when(heads, tx.article_number(F.col("clause_no")))).withColumn("clause_title", title).drop("heads_", "appends_")


def section_said(norm: Column, clause_no: Column, block_type: Column | None = None) -> Column:
    """Section that a block's text speaks of by itself, or null."""
    signed = pr.matches(norm, v.SIGNATURE_SIGNAL, ["記名押印", "署名", "押印欄", "住所", "氏名", "代表者"])
    stamp = block_type.isin("signature_area", "stamp_area") if block_type is not None else F.lit(False)
    return roles.first_of([
        ("main_contract", (norm == "") | clause_no.startswith("第")),
        ("special_provisions", norm.contains("特記事項")),
        ("appendix", pr.matches(norm, v.APPENDIX_SIGNAL, ["別", "付属資料", "仕様書"]) | pr.any_of(norm, v.RESTART_SIGNAL.split("|"))),
        ("instruction", pr.matches(norm, v.INSTRUCTION, ["要領", "記載例"])),
        ("form", pr.matches(norm, f"{v.FORM_SIGNAL}|{v.TAIL_FORM_SIGNAL}", ["様式", "書", "追加", "任意記載"]) | pr.matches(norm, v.BLANK_ARTICLE, ["条"])),
        ("signature", stamp | pr.matches(norm, v.EXECUTION, ["証", "作成", "電磁的記録", "電子署名"]) | signed),
    ], None)


def section_of(norm: Column, clause_no: Column, seen: Column, block_type: Column | None = None) -> Column:
    """Section that a block's text speaks of; preamble until an article heading was ``seen``."""
    return F.coalesce(section_said(norm, clause_no, block_type), F.when(seen, "main_contract").otherwise("preamble"))


def boundary_signal(norm: Column, section: Column) -> Column:
    """Whether a block opens the section it is taken for, by words of that section."""
    words = {"special_provisions": "特記事項", "appendix": f"{v.APPENDIX_SIGNAL}|{v.RESTART_SIGNAL}", "form": f"{v.FORM_SIGNAL}|{v.TAIL_FORM_SIGNAL}", "instruction": v.INSTRUCTION, "signature": f"{v.SIGNATURE_SIGNAL}|{v.EXECUTION}", "main_contract": f"^\\s*第{v.NUMBER}\\s*条"}
    out = F.lit(False)
    for name, pattern in words.items():
        out = F.when(section == name, norm.rlike(pattern)).otherwise(out)
    return out


def boundary_category(norm: Column, section: Column) -> Column:
    """Why a boundary is doubtful: tail_restart, signature, form_instruction, appendix or other."""
    return roles.first_of([("tail_restart", norm.rlike(v.RESTART_SIGNAL)), ("signature", section == "signature"), ("form_instruction", section.isin("form", "instruction")), ("appendix", section == "appendix")], "other")


def subtitle_candidate(norm: Column, clause_no: Column, searchable: Column) -> Column:
    """A title in brackets that may belong to the next article."""
    title = F.trim(F.regexp_extract(norm, r"^\s*[(]([^)]{1,60})[)]\s*$", 1))
    return F.coalesce(clause_no.startswith("第"), F.lit(False)) & ~pr.is_annotation(norm) & (title != "") & (F.length(title) <= 22) & ~title.rlike("[。、:;]") & (searchable | (F.length(title) > 4))


def in_body_reference(norm: Column) -> Column:
    """第N条 that cites: a heading by shape only."""
    tail = F.regexp_extract(F.regexp_replace(norm, r"\s+", ""), "^第[^条]*条(.*)$", 1)
    return tail.rlike(f"^({v.CITATION_TAIL}|{v.REFERENCE_CHAIN})")


def embedded_headings(norm: Column) -> Column:
    """Parts of a text: cut before each article number that follows the end of a sentence or a bracket and doesn't cite.

    Splitting compiles its pattern for each row, a match doesn't: only texts with a cut are split.
    """
    cut = rf"(?<=[。.:;)\]】]\s?)(?=第{v.NUMBER}条(?!\s*{v.CITATION_TAIL}))"
    parts = F.transform(F.when(norm.rlike(cut), F.split(norm, cut)).otherwise(F.array(norm)), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def single_heading(norm: Column) -> Column:
    """A chapter heading that is written twice, once."""
    words, c = F.split(norm, " "), F.regexp_replace(norm, " ", "")
    half, n = (F.size(words) / 2).cast("int"), F.length(c)
    left, right = F.array_join(F.slice(words, 1, F.greatest(half, F.lit(1))), " "), F.array_join(F.slice(words, half + 1, F.greatest(half, F.lit(1))), " ")
    by_words = (F.size(words) >= 4) & (F.size(words) % 2 == 0) & (left == right)
    by_signs = (n % 2 == 0) & (n >= 8) & (F.substr(c, F.lit(1), (n / 2).cast("int")) == F.substr(c, (n / 2 + 1).cast("int")))
    heading = (F.length(norm) <= 100) & norm.rlike(f"^{v.HEADING_UNITS}")
    return F.when(heading & by_words, left).when(heading & by_signs, F.substr(c, F.lit(1), (n / 2).cast("int"))).otherwise(norm)


def single_prefix(norm: Column, clause_no: Column) -> Column:
    """A clause's text whose heading, bracketed title or number is not said twice at once."""
    c = F.regexp_replace(norm, rf"({v.HEADING_UNITS}\s*[^\n]{{0,30}}|特記事項|附則)\s+\1", "$1")
    c = F.regexp_replace(c, r"([(][^)]{1,40}[)])\s+\1", "$1")
    twice = c.startswith(F.concat(clause_no, clause_no)) | c.startswith(F.concat(clause_no, F.lit(" "), clause_no))
    rest = F.regexp_replace(c, rf"^\s*(第{v.NUMBER}条)(\s*\1)+\s*", "")
    return F.when(F.coalesce(twice, F.lit(False)), F.trim(F.concat(clause_no, F.lit(" "), rest))).otherwise(c)


def with_sections(blocks: DataFrame) -> DataFrame:
    """Adds section_type: what a block says, and appendix from an appendix on until an article heading of the main text can't be
    told from one of the appendix."""
    before = by_doc().rowsBetween(Window.unboundedPreceding, 0)
    norm = F.col("norm")
    # what texts say is told before they are sorted, so that queries without texts sort narrow rows
    rows = blocks.withColumns({"said_": section_said(norm, F.coalesce("clause_no", F.lit(""))), "tail_": pr.matches(norm, APPENDIX, APPENDICES)})
    rows = rows.withColumns({"seen_": F.coalesce(F.max(F.col("clause_no").startswith("第")).over(before), F.lit(False)), "tail_": F.max("tail_").over(before)})
    said = F.coalesce("said_", F.when(F.col("seen_"), "main_contract").otherwise("preamble"))
    return rows.withColumn("section_type", F.when((said != "signature") & F.col("tail_"), "appendix").otherwise(said)).drop("seen_", "said_", "tail_")


def with_clauses(blocks: DataFrame) -> DataFrame:
    """Adds clause_ord: a running count of boundaries. A heading or a change of section begins a clause; noise never does."""
    start = F.col("clause_no").isNotNull() | (F.col("section_type") != F.lag("section_type").over(by_doc())) | F.lag("section_type").over(by_doc()).isNull()
    return blocks.withColumn("start", start.cast("int")).withColumn("clause_ord", F.sum("start").over(by_doc().rowsBetween(Window.unboundedPreceding, 0)))


def segmented(blocks: DataFrame) -> DataFrame:
    kept = blocks.filter(~pr.is_page_number(F.col("norm")) & ~pr.is_annotation(F.col("norm")))
    return with_clauses(with_sections(with_headings(kept)))


def ordered(value: Column, order: str = "ord") -> Column:
    """Values of a group as an array in that order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("v")))), lambda x: x.v)


def evidence(blocks: DataFrame) -> Column:
    """Where a block's text is from; engine and conf are null for blocks that come without them."""
    return F.struct("block_id", "page", *[F.col(n) if n in blocks.columns else F.lit(None).cast(t).alias(n) for n, t in (("engine", "string"), ("conf", "double"))])


def clauses(blocks: DataFrame) -> DataFrame:
    """A row for each clause: clause_id, clause_no, clause_title, text, pages, block_ids, evidence, section_type, flags.

    Blocks have doc_id, ord, page, norm and block_id, and engine and conf if they are known."""
    g = segmented(blocks).groupBy("doc_id", "clause_ord").agg(
        F.min_by("clause_no", "ord").alias("clause_no"),
        F.min_by("article", "ord").alias("article"),
        F.min_by("clause_title", "ord").alias("clause_title"),
        F.array_join(ordered(F.col("norm")), "\n").alias("text"),
        F.min("page").alias("page_start"),
        F.max("page").alias("page_end"),
        F.array_distinct(ordered(F.col("block_id"))).alias("block_ids"),
        ordered(evidence(blocks)).alias("evidence"),
        F.min_by("section_type", "ord").alias("section_type"),
        F.count(F.lit(1)).alias("n_blocks"),
    )
    flags = F.filter(F.array(F.when(F.length("text") < 20, F.lit("short_clause_text")), F.when((F.col("n_blocks") == 1) & F.col("clause_no").isNotNull(), F.lit("heading_only"))), lambda x: x.isNotNull())
    return g.withColumn("clause_id", F.format_string("clause_%03d", "clause_ord")).withColumn("flags", flags)


def boundary_score(prev: dict[str, Column], cur: dict[str, Column]) -> Column:
    """Confidence of the boundary between two clauses: more for the next number and a near page, less for another section, a
    number that is missing or doesn't rise, a short text and one that begins or ends in the middle of a sentence."""
    n, p = cur["article"], prev["article"]
    number = F.when(n == p + 1, 0.30).when(n <= p, -0.40).when(n.isNotNull() & p.isNotNull(), 0.0).when(cur["clause_no"].isNull(), -0.18).otherwise(0.0)
    text = tx.normalize_whitespace(cur["text"])
    marks = [(prev["section_type"] != cur["section_type"], -0.35), (F.length(text) <= 16, -0.10), (text.rlike(v.ORPHAN_HEAD), -0.15), (text.rlike(f"({v.alternatives(v.CLAUSE_ENDS)})$"), -0.08)]
    score = F.lit(0.55) + number + F.when(cur["page_start"] - prev["page_end"] <= 1, 0.08).otherwise(-0.10)
    for holds, points in marks:
        score = score + F.when(holds, points).otherwise(0.0)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 6)


def boundary_confidence(c: DataFrame) -> DataFrame:
    """Clauses that follow another one, with the confidence of the boundary between them."""
    w = by_doc("clause_ord")
    names = ("section_type", "article", "page_end")
    rows = c.withColumns({f"{n}_before": F.lag(n).over(w) for n in names})
    prev = {n: F.col(f"{n}_before") for n in names}
    cur = {n: F.col(n) for n in ("section_type", "article", "page_start", "clause_no", "text")}
    return rows.filter("section_type_before is not null").withColumn("confidence", boundary_score(prev, cur))


def _merge(last: Column, x: Column, flag: str) -> Column:
    return F.struct(
        last["i"].alias("i"), last["clause_no"].alias("clause_no"), last["article"].alias("article"), last["clause_title"].alias("clause_title"), last["section_type"].alias("section_type"), last["page_start"].alias("page_start"),
        F.greatest(last["page_end"], x["page_end"]).alias("page_end"), F.concat(F.rtrim(last["text"]), F.lit("\n"), F.ltrim(x["text"])).alias("text"), F.array_distinct(F.concat(last["block_ids"], x["block_ids"])).alias("block_ids"), F.array_union(last["flags"], F.array(F.lit(flag))).alias("flags"),
    )


def once(value: Column, then) -> Column:
    """``then`` of a value that is evaluated once, however often ``then`` names it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _fold(items: Column, holds, flag: str) -> Column:
    """A document's clauses in order, each merged into the one kept before it where ``holds``."""

    def step(kept: Column, x: Column) -> Column:
        last = F.element_at(kept, -1)
        return F.when((F.size(kept) > 0) & F.coalesce(holds(last, x), F.lit(False)), F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(_merge(last, x, flag)))).otherwise(F.concat(kept, F.array(x)))

    return once(items, lambda every: F.aggregate(every, F.filter(every, lambda x: F.lit(False)), step))


def _lines(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "\n"), lambda x: F.trim(x) != ""))


def is_orphan(last: Column, x: Column) -> Column:
    """A short paragraph without a number, after a clause with one in its section."""
    t = tx.normalize_whitespace(x["text"])
    return (last["section_type"] == x["section_type"]) & x["clause_no"].isNull() & last["clause_no"].isNotNull() & (t != "") & ~pr.is_annotation(t) & (F.length(t) <= 140) & ~t.startswith("第")


def is_trailing(last: Column, x: Column, least: int = 20) -> Column:
    t = tx.normalize_whitespace(x["text"])
    return (last["section_type"] == x["section_type"]) & x["clause_no"].isNull() & last["clause_no"].isNotNull() & ((F.length(t) <= least) | t.rlike(v.ORPHAN_HEAD) | (_lines(x["text"]) <= 2) & pr.is_fragment(t))


def is_reversed(last: Column, x: Column) -> Column:
    """A number that goes back, in a short clause with a doubtful boundary."""
    return (last["section_type"] == x["section_type"]) & (x["article"] < last["article"]) & (F.length(tx.normalize_whitespace(x["text"])) <= 80) & (_lines(x["text"]) <= 3) & (boundary_score(last, x) < LOW_BOUNDARY)


def is_citation(last: Column, x: Column) -> Column:
    """A citation that was taken for a clause: its number goes on as citations do."""
    c = F.regexp_replace(x["text"], r"\s+", "")
    tail = F.substr(c, F.length(x["clause_no"]) + 1)
    far = x["article"] >= 150
    main = (last["section_type"] == "main_contract") & (x["section_type"] == "main_contract")
    return main & x["article"].isNotNull() & x["clause_title"].isNull() & c.startswith(x["clause_no"]) & (tail.rlike(f"^第{v.NUMBER}(項|号|節|款)") | far & (tail.rlike(f"^{v.CITATION_TAIL}") | (tail == "")))


MERGES = {"attached_orphan_paragraph": is_orphan, "merged_trailing_fragment": is_trailing, "repaired_reversed_clause_number": is_reversed, "merged_citation_like_clause": is_citation}


def _marked(x: Column, last: Column) -> Column:
    same = F.coalesce(last["section_type"] == x["section_type"], F.lit(False))
    back = same & F.coalesce(x["article"] < last["article"], F.lit(False))
    low = same & (x["section_type"] == "main_contract") & F.coalesce(boundary_score(last, x) < LOW_BOUNDARY, F.lit(False))
    marks = F.filter(F.array(F.when(back, "REVERSED_CLAUSE_NUMBER"), F.when(low, "LOW_BOUNDARY_CONFIDENCE")), lambda m: m.isNotNull())
    return x.withField("flags", F.array_union(x["flags"], marks))


def repaired(c: DataFrame, merges: list[str] | None = None) -> DataFrame:
    """Clauses after the merges, in order of MERGES: each is a fold over a document's clauses against the last one kept.

    Headings said twice are said once before citations are looked for. A document's clauses are few, so they are one array.
    All merges together are followed by flags of numbers that still go back and of doubtful boundaries.
    """
    item = F.struct(F.col("clause_ord").alias("i"), "clause_no", "article", "clause_title", "section_type", "page_start", "page_end", "text", "block_ids", "flags")
    rows = c.groupBy("doc_id").agg(F.array_sort(F.collect_list(item), lambda a, b: (a.i - b.i).cast("int")).alias("items"))
    for name in merges or list(MERGES):
        if name == "merged_citation_like_clause":
            said_once = lambda x: once(tx.normalize_whitespace(x.text), lambda t: once(single_prefix(t, x.clause_no), lambda p: F.when(p == t, x.text).otherwise(p)))
            rows = rows.withColumn("items", F.transform("items", lambda x: x.withField("text", said_once(x))))
        rows = rows.withColumn("items", _fold(F.col("items"), MERGES[name], name))
    # a number that goes back and stays, and a boundary in the main text that is doubtful after all merges
    flagged = once(F.col("items"), lambda every: F.transform(every, lambda x, i: once(F.get(every, i - 1), lambda last: _marked(x, last))))
    rows = rows.withColumn("items", flagged) if merges is None else rows
    # no document is without clauses; an outer generator has no filter before it that makes the items again
    return rows.select("doc_id", F.explode_outer("items").alias("c")).select("doc_id", F.col("c.i").alias("clause_ord"), *[F.col(f"c.{n}") for n in ("clause_no", "article", "clause_title", "section_type", "page_start", "page_end", "text", "block_ids", "flags")])


def stability(c: DataFrame) -> DataFrame:
    """For each document: clauses, short ones, bare headings, numbers that go back, and whether the split is unstable."""
    back = (F.col("article") <= F.lag("article").over(by_doc("clause_ord"))).cast("int")
    rows = c.withColumn("back", F.coalesce(back, F.lit(0)))
    g = rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_clauses"),
        F.count_if(F.array_contains("flags", "short_clause_text")).alias("n_short"),
        F.count_if(F.array_contains("flags", "heading_only")).alias("n_bare"),
        F.sum("back").alias("n_back"),
    )
    return g.withColumn("unstable", ((F.col("n_clauses") >= 4) & (F.col("n_short") / F.col("n_clauses") >= 0.55)) | (F.col("n_bare") >= 2) | (F.col("n_back") >= 3))
