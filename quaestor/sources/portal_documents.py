"""Whole documents of portal pages as native expressions: rows of a partial answer, and the page of a single hit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T

# Fields of a row and their labels on the page.
ROW_LABELS = {
    "numero": "Número", "classe": "Classe", "relator": "Relator(a)", "orgao_julgador": "Órgão julgador", "data_julgamento": "Data",
    "data_publicacao": "Data da publicação", "fonte_publicacao": "Fonte da publicação",
}
#: Digests of no more characters than this are headings, not digests.
SHORT = 50


def _held(value: Column, f) -> Column:
    """f of a value that is worked out once, however often f reads it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _plain(c: Column) -> Column:
    return T.trimmed(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", ""), r"\s+", " "))


def partial_rows(body: Column, prefix: str = "tabelaDocumentos") -> Column:
    """array<struct(indice, fields of ROW_LABELS, decisao, ementa)> of a partial answer, by row number.

    What lies in its CDATA parts counts, or all where there is none. A field is read between its row's marks only, so a row that lacks
    one doesn't take its neighbour's. Digests stand apart from the rows and go to them by their order; short ones don't count. A row
    without number and digest is left out. Null gives no row.
    """
    text = T.unescape(F.coalesce(body, F.lit("")))
    parts = F.regexp_extract_all(text, F.lit(r"(?s)<!\[CDATA\[(.*?)\]\]>"), F.lit(1))
    text = F.when(F.size(parts) > 0, F.array_join(parts, "")).otherwise(text)
    return _held(text, lambda x: _rows(x, prefix))


def _rows(text: Column, prefix: str) -> Column:
    mark = rf"{prefix}:(\d+):"
    cut = F.transform(F.split(text, f"(?={prefix}:[0-9]+:)"), lambda p: F.struct(F.regexp_extract(p, f"^{mark}", 1).try_cast("int").alias("at"), p.alias("p")))
    found = F.filter(F.transform(F.regexp_extract_all(text, F.lit(r'(?s)painel_ementa-[^"]+"[^>]*>(.*?)</div>'), F.lit(1)), _plain), lambda x: F.length(x) > SHORT)

    def field(p: Column, label: str, inside: str = "[^<]+") -> Column:
        return F.nullif(_plain(F.regexp_extract(p, rf"(?s)label_pontilhada[^>]*>\Q{label}\E</span>.*?<td[^>]*>({inside})</td>", 1)), F.lit(""))

    def one(x: Column, n: Column, k: Column) -> Column:
        own = F.array_join(F.transform(F.filter(x["pieces"], lambda p: p["at"] == n), lambda p: p["p"]), "")
        return _held(own, lambda p: F.struct(n.alias("indice"), *[field(p, label).alias(name) for name, label in ROW_LABELS.items()], field(p, "Decisão", ".*?").alias("decisao"), F.get(x["digests"], k).alias("ementa")))

    def rows(x: Column) -> Column:
        numbers = F.array_sort(F.array_distinct(F.filter(F.transform(x["pieces"], lambda p: p["at"]), lambda n: n.isNotNull())))
        return F.transform(numbers, lambda n, k: one(x, n, k))

    return F.filter(_held(F.struct(cut.alias("pieces"), found.alias("digests")), rows), lambda r: r["numero"].isNotNull() | r["ementa"].isNotNull())


def titled_paragraphs(html: Column) -> Column:
    """array<struct(title, text)> of the titled paragraphs of a document's page; markup of a text separates its lines."""
    pieces = F.split(html, r'<[^>]*class="paragrafoBRS"[^>]*>')

    def one(piece: Column) -> Column:
        sides = F.split(piece, r'<[^>]*class="docTexto"[^>]*>', 2)
        title = _plain(F.regexp_replace(sides[0], r'(?s)^.*?class="docTitulo"[^>]*>', ""))
        body = F.regexp_replace(F.coalesce(F.get(sides, F.lit(1)), F.lit("")), r"(?s)</div>\s*</div>.*", "")
        lines = F.filter(F.transform(F.split(F.regexp_replace(body, "<[^>]+>", "\n"), "\n"), T.trimmed), lambda x: x != "")
        return F.struct(T.unescape(title).alias("title"), T.unescape(F.array_join(lines, "\n")).alias("text"))

    held = F.filter(pieces, lambda p: p.contains('class="docTitulo"') & p.contains('class="docTexto"'))
    return F.transform(held, one)


def single_document(html: Column, base: str = "ACOR") -> Column:
    """struct(numero, relator, orgao, publicado, julgamento, tipo, ementa) of a page that is one document; null for any other page.

    Of paragraphs with the same title the first counts. Without a case number in its usual form the whole field is the number.
    """
    found = _held(titled_paragraphs(html), lambda pairs: _fields(pairs, base))
    return F.when(html.contains('class="documento"') & (found["numero"] != ""), found)


def _fields(pairs: Column, base: str) -> Column:

    def of(title: str) -> Column:
        return F.coalesce(F.get(F.filter(pairs, lambda x: x["title"] == title), F.lit(0))["text"], F.lit(""))

    case = T.collapse(of("Processo"))
    number = F.regexp_extract(case, r"^(.+?\d)\s*/\s*[A-Z]{2}\b", 1)
    issue = of("Data da Publicação/Fonte")
    published = F.concat_ws(" ", *[F.nullif(F.regexp_extract(issue, r"\b(DJEN|DJe|DJ)\s+(\d{2}/\d{2}/\d{4})", k), F.lit("")) for k in (1, 2)])
    return F.struct(
        F.coalesce(F.nullif(number, F.lit("")), case).alias("numero"),
        F.regexp_replace(T.collapse(of("Relator")), r"\s*\(\d+\)\s*$", "").alias("relator"),
        F.coalesce(F.nullif(T.collapse(of("Órgão Julgador")), F.lit("")), F.lit("Superior Tribunal de Justiça")).alias("orgao"),
        published.alias("publicado"),
        F.nullif(T.trimmed(of("Data do Julgamento")), F.lit("")).alias("julgamento"),
        F.when(F.exists(pairs, lambda x: x["title"] == "Acórdão"), "ACÓRDÃO").otherwise(base).alias("tipo"),
        T.collapse(of("Ementa")).alias("ementa"),
    )
