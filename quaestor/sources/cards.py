"""Records from the court portals' pages: lists of cards, bulletins, label and value cards. Native expressions on the markup."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .files import scratch

# What lines of a card look like on the portal.
KIND = r"^\((.+)\)$"
REPORTER = r"(?i)^Ministr[oa]\b"
PUBLISHED = r"^(?:DJe|DJEN|DJ|RSTJ|RT)\b.*?\d{2}/\d{2}/\d{4}"
DECIDED = r"^Decis[ãa]o:\s*(\d{2}/\d{2}/\d{4})"
CARD = "itemlistadocumentos"


def plain_lines(html: Column) -> Column:
    """Lines of text between tags, without blank ones."""
    lines = F.split(T.unescape(F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>", ""), r"<[^>]*>", "\n")), "\n")
    return F.filter(F.transform(lines, T.collapse), lambda x: x != "")


def blocks(html: Column, cls: str) -> Column:
    """The markup from each element of a class to the next one of it."""
    pieces = F.split(html, rf'(?=<\w+[^>]*class="[^"]*\b{cls}\b[^"]*")')
    return F.filter(pieces, lambda x: x.rlike(rf'^<\w+[^>]*class="[^"]*\b{cls}\b'))


def card_record(lines: Column, kind: str) -> Column:
    """struct(number, kind, reporter, published, decided, summary, cut) of a card's lines.

    One pass with a state: before the number, in it, between it and the summary, in the summary, done. What stands nowhere is skipped; of a
    field the first counts. A summary that ends with three dots was cut by the portal.
    """
    names = ("state", "number", "kind", "reporter", "published", "decided", "summary")
    start = F.struct(*[F.lit(x).cast("string").alias(n) for n, x in zip(names, ("start", "", None, None, None, None, ""), strict=True)])

    def step(acc: Column, x: Column) -> Column:
        state, low = acc["state"], F.lower(x)
        head, body = (low == "processo") & (state != "done"), (low == "ementa") & (state != "done")
        inside = ~head & ~body
        in_number, in_summary = inside & (state == "number"), inside & (state == "summary")
        kind_line = in_number & x.rlike(KIND)
        other = inside & state.isin("start", "meta")
        reporter = other & x.rlike(REPORTER) & acc["reporter"].isNull()
        published = other & ~reporter & x.rlike(PUBLISHED) & acc["published"].isNull()
        decided = other & ~reporter & ~published & x.rlike(DECIDED) & acc["decided"].isNull()

        def joined(a: Column, b: Column) -> Column:
            return F.trim(F.concat(a, F.lit(" "), b))

        return F.struct(
            F.when(head, "number").when(body, "summary").when(in_summary & (x == "(+)"), "done").when(kind_line, "meta").otherwise(state).alias("state"),
            F.when(in_number & ~kind_line, joined(acc["number"], x)).otherwise(acc["number"]).alias("number"),
            F.when(kind_line, F.regexp_extract(x, KIND, 1)).otherwise(acc["kind"]).alias("kind"),
            F.when(reporter, F.trim(F.regexp_replace(x, r"\s*\(\d+\)\s*$", ""))).otherwise(acc["reporter"]).alias("reporter"),
            F.when(published, x).otherwise(acc["published"]).alias("published"),
            F.when(decided, F.regexp_extract(x, DECIDED, 1)).otherwise(acc["decided"]).alias("decided"),
            F.when(in_summary & (x != "(+)"), joined(acc["summary"], x)).otherwise(acc["summary"]).alias("summary"),
        )

    def done(acc: Column) -> Column:
        return F.struct(acc["number"].alias("number"), F.coalesce(acc["kind"], F.lit(kind)).alias("kind"), acc["reporter"].alias("reporter"), acc["published"].alias("published"), acc["decided"].alias("decided"), acc["summary"].alias("summary"), acc["summary"].endswith("...").alias("cut"))

    return F.aggregate(lines, start, step, done)


def listed_cards(html: Column, kind: str = "ACOR") -> Column:
    """array of card_record of a list page, in order."""
    return F.transform(blocks(html, CARD), lambda x: card_record(plain_lines(x), kind))


def told_total(html: Column) -> Column:
    """The number of hits that a list page tells; null if it tells none."""
    return F.nullif(F.replace(F.regexp_extract(F.regexp_extract(html, r'(?s)class="[^"]*\bnumDocs\b[^"]*"[^>]*>(.*?)</', 1), r"(\d[\d.]*)", 1), F.lit("."), F.lit("")), F.lit("")).cast("bigint")


# --- bulletins --------------------------------------------------------------------------------------------------------
def bulletin_notes(html: Column) -> Column:
    """array<struct(edition, date, organ, process, theme, point)> of a bulletin page; organ only where the page prints it.

    A label's value stands on its own line or on the next. A block without process, theme and point is no note.
    """
    def shown(x: Column, pattern: str) -> Column:
        return T.collapse(T.unescape(F.regexp_replace(F.regexp_extract(x, pattern, 1), r"<[^>]*>", " ")))

    def value(x: Column, label: str) -> Column:
        found = shown(x, rf'(?s)class="clsInformativoLabel"[^>]*>\s*{label}\s*</.*?class="clsInformativoTexto(?:Formatado)?"[^>]*>(.*?)</div>')
        return F.nullif(F.regexp_replace(found, r"\s+([.,;:)])", "$1"), F.lit(""))

    def note(x: Column) -> Column:
        title = shown(x, r'(?s)id="temaNota\d*"[^>]*>(.*?)</')
        edition = r"^(Informativo de Jurisprud\S+.*?n\.\s*\d+).*?(\d{1,2} de \w+ de \d{4})"
        return F.struct(
            F.nullif(F.regexp_extract(title, edition, 1), F.lit("")).alias("edition"), F.nullif(F.regexp_extract(title, edition, 2), F.lit("")).alias("date"),
            F.nullif(shown(x, r'(?s)class="clsInformativoOrgaojulgador"[^>]*>(.*?)</'), F.lit("")).alias("organ"),
            F.nullif(F.regexp_replace(F.regexp_extract(F.coalesce(value(x, "Processo"), F.lit("")), r"^(.*?)(?:,\s*Rel\.|$)", 1), r"^[ ,]+|[ ,]+$", ""), F.lit("")).alias("process"),
            value(x, "Tema").alias("theme"), value(x, "Destaque").alias("point"),
        )

    return F.filter(F.transform(blocks(html, "clsInformativoBlocoItem"), note), lambda n: F.coalesce(n["process"], n["theme"], n["point"]).isNotNull())


def carried(rows: DataFrame, order: list[str], value: str, run: str, out: str, parts: int | None = None) -> DataFrame:
    """``value`` carried forward over the rows in their order while ``run`` stays the same (a null equals a null), as ``out``.

    There need be no key that parts the rows: they are dealt by ranges of the order, each range is filled by itself, and what comes into a range
    is found from one row for each of those before. Columns of ``order`` tell rows apart.
    """
    spark, path = rows.sparkSession, scratch(rows.sparkSession, "ranges")
    dealt = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    dealt.withColumn("_part", F.spark_partition_id()).write.parquet(path)  # the deal is sampled: it is read, not made again
    held = spark.read.parquet(path)
    by = Window.partitionBy("_part").orderBy(*order)
    place = F.row_number().over(by)
    broken = ~F.col(run).eqNullSafe(F.lag(run).over(by)) & (place > 1)
    told = held.withColumn("_event", F.when(F.col(value).isNotNull() | broken, F.struct(F.col(value).alias("v"))))
    told = told.withColumn("_last", F.last("_event", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    ends = told.groupBy("_part").agg(F.min_by(run, F.struct(*order)).alias("first"), F.max_by(run, F.struct(*order)).alias("last"), F.max_by("_last", F.struct(*order)).alias("event"))
    carry, before, into = None, None, []
    for r in ends.orderBy("_part").collect():  # a row for each range
        into.append((r["_part"], carry if before is not None and before == (r["first"],) else None))
        carry = r["event"]["v"] if r["event"] is not None else into[-1][1]
        before = (r["last"],)
    incoming = spark.createDataFrame(into, f"_part int, _in {held.schema[value].dataType.simpleString()}")
    filled = told.join(F.broadcast(incoming), "_part")
    return filled.withColumn(out, F.when(F.col("_last").isNotNull(), F.col("_last.v")).otherwise(F.col("_in"))).drop("_part", "_event", "_last", "_in")


# --- label and value cards -----------------------------------------------------------------------------------------------
def labelled_cards(html: Column) -> Column:
    """array<struct(kind, number, organ, fields)> of cards of resLabel and resValue pairs; the organ stands in the citation text."""
    organ = r"(?i)TJRJ,\s*[^,]+,\s*([^,]+(?:câmara|turma|seção|grupo|conselho|órgão)[^,]*),"

    def first(x: Column, pattern: str) -> Column:
        return F.nullif(T.collapse(T.unescape(F.regexp_replace(F.regexp_extract(x, pattern, 1), r"<[^>]*>", " "))), F.lit(""))

    def card(x: Column) -> Column:
        pair = r'(?s)<div class="resLabel"[^>]*>(.*?)</div>\s*<div class="resValue"[^>]*>(.*?)</div>'
        labels = F.transform(F.regexp_extract_all(x, F.lit(pair), F.lit(1)), lambda v: F.upper(T.collapse(T.unescape(v))))
        values = F.transform(F.regexp_extract_all(x, F.lit(pair), F.lit(2)), lambda v: T.collapse(T.unescape(F.regexp_replace(v, r"<[^>]*>", " "))))
        last = F.aggregate(F.arrays_zip(labels.alias("k"), values.alias("v")), F.create_map().cast("map<string,string>"), lambda m, y: F.map_concat(F.map_filter(m, lambda k, _: k != y["k"]), F.create_map(y["k"], y["v"])))
        number = F.coalesce(first(x, r'(?s)class="numero-processo"[^>]*>(.*?)</a>'), F.nullif(F.regexp_extract(x, r"num_processo=(\d+)", 1), F.lit("")))
        citation = T.unescape(F.regexp_extract(x, r'data-citacao="([^"]*)"', 1))
        return F.struct(first(x, r'(?s)class="resValueTipoJurisprudencia"[^>]*>(.*?)</div>').alias("kind"), number.alias("number"), F.nullif(T.collapse(F.regexp_extract(citation, organ, 1)), F.lit("")).alias("organ"), last.alias("fields"))

    return F.transform(blocks(html, "resultadoItem"), card)


def ruled_rows(html: Column) -> Column:
    """array<struct(judge, decided, organ, summary)> of a table in which the row before a summary tells of it."""
    rows = F.regexp_extract_all(html, F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    told = F.transform(rows, lambda x, i: F.struct(x.alias("row"), F.when(i > 0, F.get(rows, i - 1)).alias("before")))

    def record(x: Column) -> Column:
        parts = F.transform(F.split(T.collapse(T.unescape(F.regexp_replace(F.coalesce(x["before"], F.lit("")), r"<[^>]*>", " - "))), r"\s+-\s+|^-\s+|\s+-$"), lambda p: F.trim(p))
        parts = F.filter(parts, lambda p: p != "")
        decided = F.regexp_extract(F.array_join(parts, " - "), r"(?i)Julgamento[:\s]+(\d{2}/\d{2}/\d{4})", 1)
        courts = F.filter(F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0))), lambda p: T.fold(p).rlike(r"camara|turma|secao|orgao"))
        organ = F.coalesce(F.try_element_at(courts, F.lit(-1)), F.when(F.size(parts) >= 3, F.try_element_at(parts, F.lit(-1))))
        judge = F.trim(F.regexp_replace(F.coalesce(F.get(parts, F.lit(0)), F.lit("")), r"(?i)^(?:Des|Dr)(?:\(a\))?\.?\s*", ""))
        summary = F.trim(F.regexp_replace(T.unescape(F.regexp_extract(x["row"], r"(?s)<textarea[^>]*>(.*?)</textarea>", 1)), r"(?i)^\s*ementa:\s*", ""))
        return F.struct(F.nullif(judge, F.lit("")).alias("judge"), F.nullif(decided, F.lit("")).alias("decided"), F.initcap(organ).alias("organ"), summary.alias("summary"))

    return F.transform(F.filter(told, lambda x: x["row"].rlike(r'class="divEmenta"')), record)


# --- panels, digests, tables of labels ------------------------------------------------------------------------------------
def _shown(x: Column, pattern: str, collapse: Callable[[Column], Column] = T.collapse) -> Column:
    """Text of the first group of a pattern, without tags; null if there is none."""
    return F.nullif(collapse(T.unescape(F.regexp_replace(F.regexp_extract(x, pattern, 1), r"<[^>]*>", " "))), F.lit(""))


def panels(html: Column) -> Column:
    """array<struct(id, number, class, reporter, subjects, decided, summary)> of panels whose fields carry their names as data-id.

    A panel without a number's field is none of a decision.
    """
    def of(x: Column, name: str) -> Column:
        return _shown(x, rf'(?s)<span[^>]*data-id="{name}"[^>]*>(.*?)</span>', T.one_line)

    def one(x: Column) -> Column:
        subjects = _shown(x, r"(?s)<dt[^>]*>\s*Assuntos:?\s*</dt>\s*<dd[^>]*>(.*?)</dd>")
        summary = F.nullif(T.strip_blanks(F.regexp_replace(of(x, "ementa"), r"^EMENTA *: *", "")), F.lit(""))
        return F.struct(of(x, "id").alias("id"), of(x, "numero_processo").alias("number"), of(x, "classe").alias("class"), of(x, "ministro_relator").alias("reporter"), subjects.alias("subjects"), of(x, "data_julgamento").alias("decided"), summary.alias("summary"))

    return F.transform(F.filter(blocks(html, "panel"), lambda x: F.contains(x, F.lit('data-id="numero_processo"'))), one)


def panels_total(html: Column) -> Column:
    """The count that a page of panels tells outside their fields; null where it tells none, which may be a zero or a refusal."""
    around = F.regexp_replace(html, r'(?s)<span[^>]*data-id="[^>]*>.*?</span>', " ")
    flat = T.collapse(F.regexp_replace(around, r"<[^>]*>", " "))
    return F.nullif(F.replace(F.regexp_extract(flat, r"(?i)(\d+)\s*(?:-|a|até)\s*(\d+)\s+de\s+(\d[\d.]*)", 3), F.lit("."), F.lit("")), F.lit("")).cast("bigint")


# What a digest's note says of a digest that isn't in force.
OUT_OF_FORCE = ["CANCELADA", "REVOGADA", "SUPERADA"]


def digests(html: Column) -> Column:
    """array<struct(number, subject, text, organ, status, note)> of a page of digests.

    The status stands beside the number, or in a note within the text; what comes before such a note is the text. A text that the
    portal serves without marks ends before its last bracket, which tells the organ.
    """
    note_mark = rf"(?iu)SÚMULA\s+({'|'.join(OUT_OF_FORCE)})\s*:\s*"

    def one(x: Column) -> Column:
        block = F.regexp_extract(x, r'(?s)class="blocoVerbete"[^>]*>(.*?)</section>', 1)
        subject = _shown(block, r'(?s)class="ramoSumula"[^>]*>(.*?)</div>')
        marked_note = _shown(block, r'(?s)class="clsCOM"[^>]*>(.*?)</div>')
        bare = F.regexp_replace(block, r'(?s)<div class="(?:ramoSumula|clsCOM)"[^>]*>.*?</div>', " ")
        flat = T.collapse(T.unescape(F.regexp_replace(bare, r"<[^>]*>", " ")))
        at = F.regexp_instr(flat, F.lit(note_mark))
        inline = F.upper(F.regexp_extract(flat, note_mark, 1))
        current = F.when(at > 0, F.trim(F.substring(flat, F.lit(1), at - 1))).otherwise(flat)
        said = F.when(at > 0, F.trim(F.regexp_replace(F.substring(flat, at, F.length(flat)), f"^{note_mark}", "")))
        text = F.coalesce(_shown(bare, r'(?s)class="clsVerbete"[^>]*>(.*?)</div>'), F.trim(F.regexp_replace(current, r"\s*\([^()]*\)\.?\s*$", "")))
        organ = F.coalesce(_shown(bare, r'(?s)class="clsOrgaoJulgador"[^>]*>(.*?)</'), F.nullif(F.regexp_extract(current, r"\((?:SÚMULA \d+,\s*)?([^(),]*(?:SEÇÃO|CORTE ESPECIAL)[^(),]*),[^()]*\)\.?\s*$", 1), F.lit("")), F.lit("Superior Tribunal de Justiça"))
        status = F.coalesce(F.upper(_shown(x, r'(?s)class="clsINDE"[^>]*>(.*?)</')), F.nullif(inline, F.lit("")))
        return F.struct(_shown(x, r'(?s)class="numeroSumula"[^>]*>(.*?)</').alias("number"), subject.alias("subject"), text.alias("text"), organ.alias("organ"), status.alias("status"), F.coalesce(marked_note, F.nullif(said, F.lit(""))).alias("note"))

    return F.transform(blocks(html, "gridSumula"), one)


# Labels of the regional portal's table and the fields they are.
REGIONAL = {"Tipo": "tipo", "Número": "numero", "Classe": "classe", "Relator(a)": "relator", "Origem": "origem", "Órgão julgador": "orgao_julgador", "Data": "data_julgamento"}


def regional_rows(html: Column) -> Column:
    """array<map<string, string>> of the regional portal's table, by row; of a cell's lines the number in the national form, or else the first, is the number.

    An answer may come as escaped text within CDATA sections. A row without number is none.
    """
    plain = T.unescape(html)
    parts = F.regexp_extract_all(plain, F.lit(r"(?s)<!\[CDATA\[(.*?)\]\]>"), F.lit(1))
    body = F.when(F.size(parts) > 0, F.array_join(parts, "")).otherwise(plain)
    rows = F.filter(F.split(body, r'(?=<tr[^>]*id="tabelaDocumentos:\d+:linha")'), lambda x: x.startswith("<tr"))

    def row(x: Column) -> Column:
        cell = r'(?s)label_pontilhada[^>]*>([^<]*)</span>.*?<td[^>]*>(.*?)</td>'
        pairs = F.arrays_zip(F.regexp_extract_all(x, F.lit(cell), F.lit(1)).alias("k"), F.regexp_extract_all(x, F.lit(cell), F.lit(2)).alias("v"))

        def pair(y: Column) -> Column:
            lines = F.filter(F.transform(F.split(F.regexp_replace(F.regexp_replace(y["v"], r"<br\s*/?>", "\n"), r"<[^>]+>", " "), "\n"), T.collapse), lambda z: z != "")
            name = F.try_element_at(F.create_map(*[F.lit(z) for kv in REGIONAL.items() for z in kv]), T.collapse(y["k"]))
            national = F.get(F.filter(lines, lambda z: z.rlike(r"^\d{7}-\d{2}\.\d{4}\.")), F.lit(0))
            return F.struct(name.alias("k"), F.when(name == "numero", F.coalesce(national, F.get(lines, F.lit(0)))).otherwise(F.nullif(F.array_join(lines, " "), F.lit(""))).alias("v"))

        known = F.filter(F.transform(pairs, pair), lambda y: y["k"].isNotNull() & y["v"].isNotNull())
        return F.aggregate(known, F.create_map().cast("map<string,string>"), lambda m, y: F.when(F.map_contains_key(m, y["k"]), m).otherwise(F.map_concat(m, F.create_map(y["k"], y["v"]))))

    return F.filter(F.transform(rows, row), lambda m: m["numero"].isNotNull())


# --- totals and errors ------------------------------------------------------------------------------------------------------
def court_totals(html: Column, courts: list[str]) -> Column:
    """map of court to the number of documents that a results page tells; courts that it doesn't name are missing, the last of a name counts."""
    cell = r"(?s)<td[^>]*>(\w+)</td>\s*<td[^>]*>.*?(\d+)\s*Documento"
    plain = T.unescape(html)
    pairs = F.arrays_zip(F.regexp_extract_all(plain, F.lit(cell), F.lit(1)).alias("k"), F.regexp_extract_all(plain, F.lit(cell), F.lit(2)).alias("v"))
    known = F.filter(pairs, lambda x: x["k"].isin(courts))
    return F.aggregate(known, F.create_map().cast("map<string,bigint>"), lambda m, x: F.map_concat(F.map_filter(m, lambda k, _: k != x["k"]), F.create_map(x["k"], x["v"].cast("bigint"))))


def portal_error(html: Column) -> Column:
    """The message of a page that tells of an error; null if it tells of none."""
    found = F.regexp_extract(html, r'ui-messages-error-detail">([^<]*)<', 1)
    said = T.collapse(F.replace(T.unescape(found), F.lit("\\n"), F.lit(" ")))
    return F.when(html.rlike(r'ui-messages-error-detail">[^<]*<'), F.coalesce(F.nullif(said, F.lit("")), F.lit("erro não detalhado pelo portal")))


def answered(html: Column) -> Column:
    """The page, if it is an answer; reading one that tells of an error fails the job with its message: no documents is something else."""
    error = portal_error(html)
    return F.when(error.isNull(), html).otherwise(F.raise_error(F.concat(F.lit("the portal told of an error: "), error)).cast("string"))
