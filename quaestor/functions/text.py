"""Text functions as Column -> Column; all native, so they stay inside the JVM's generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with accents, lower case, and their plain letters.
ACCENTED = "áàâãäåāăąéèêëēĕėęěíìîïĩīĭįóòôõöōŏőúùûüũūŭůűųçćĉċčñńņňýÿŷśŝşšźżžďģğĝġĥĵķĺļľŕŗřţťŵ"
PLAIN = "aaaaaaaaaeeeeeeeeeiiiiiiiioooooooouuuuuuuuuucccccnnnnyyysssszzzdgggghjklllrrrttw"

# Month names of the two date spellings.
MONTHS_PT = ["janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro"]
MONTHS_ES = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"]
# Entities that result pages use.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
# Labels of the risk levels.
RISK_LABELS = {"verde": "VERDE - Alinhado", "amarelo": "AMARELO - Atencao", "vermelho": "VERMELHO - Divergente"}
# Blanks of all widths.
BLANKS = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
CNJ = r"\d{7}-\d{2}\.\d{4}\.\d\.\d{2}\.\d{4}"


def fold(c: Column) -> Column:
    """Lower case without accents, length kept."""
    return F.translate(F.lower(c), ACCENTED, PLAIN)


def fold_ordinal(c: Column) -> Column:
    """fold(), ordinal signs as letters, white space collapsed."""
    return F.trim(F.regexp_replace(F.translate(fold(c), "ªº", "ao"), r"\s+", " "))


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def strip_blanks(c: Column) -> Column:
    """Without blanks at its ends, those of other widths too."""
    return F.btrim(c, F.lit(BLANKS))


def one_line(c: Column) -> Column:
    """White space to single blanks; a vertical tab is none, as in SQL."""
    return strip_blanks(F.regexp_replace(c, r"[ \t\n\f\r]+", " "))


def alnum_key(c: Column) -> Column:
    return F.regexp_replace(fold(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


def ementa_key(c: Column, size: int = 200) -> Column:
    """First ``size`` letters and digits without a leading label; null if there are fewer."""
    key = F.regexp_replace(alnum_key(c), "^ementa", "")
    return F.when(F.length(key) >= size, F.left(key, F.lit(size)))


def truncate_tokens(c: Column, tokens: int) -> Column:
    """At four characters a token, cut at the last full stop beyond the middle, marked as cut."""
    most = tokens * 4
    head = F.left(c, F.lit(most))
    back = F.instr(F.reverse(head), ".")
    stop = F.lit(most) - back
    short = F.when((back > 0) & (stop > most // 2), F.substring(head, F.lit(1), stop + 1)).otherwise(head)
    return F.when(F.length(c) <= most, c).otherwise(F.concat(short, F.lit(" [...]")))


def unescape(c: Column) -> Column:
    for name, sign in ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(sign))
    return c


def html_clean(c: Column) -> Column:
    """Entities first, then tags to blanks, then white space."""
    return collapse(F.regexp_replace(unescape(F.coalesce(c, F.lit(""))), "<[^>]+>", " "))


def full_text_html(c: Column) -> Column:
    """Text without scripts and styles; a line per tag boundary, blank lines dropped."""
    bare = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</(script|style)>", "")
    lines = F.transform(F.split(unescape(F.regexp_replace(bare, "<[^>]+>", "\n")), "\n"), lambda x: F.trim(x))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def br_to_lines(c: Column) -> Column:
    text = unescape(F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>", "\n"), "<[^>]+>", ""))
    text = F.regexp_replace(F.replace(text, F.lit("\r"), F.lit("")), r"[ \t]+\n", "\n")
    return F.regexp_replace(F.regexp_replace(text, r"^\s+|\s+$", ""), r"\n{3,}", "\n\n")


def ementa_section(c: Column) -> Column:
    """What follows the label; the collapsed text's first 2000 characters if there is none."""
    clean = html_clean(c)
    return F.when(clean.rlike("(EMENTA|Ementa)"), F.trim(F.regexp_extract(clean, r"(?s)(?:EMENTA|Ementa)\s*[:\-]?\s*(.+)$", 1))).otherwise(F.trim(F.left(clean, F.lit(2000))))


def ementa_report(c: Column) -> Column:
    """The label that is not followed by a letterhead or a case number, up to report, vote or ruling; else the text."""
    found = F.regexp_extract(c, r"(?s)\bEMENTA\b:?(?!\s*(?i:PODER JUDICI))(?!\s*\d{7}-?\d{2}\.?\d{4})(?!\s*\d{15,})[ :]*(.*?)(?:\b(?:RELAT[ÓO]RIO|VOTO|AC[ÓO]RD[ÃA]O)\b|\z)", 1)
    return F.when(F.regexp_like(c, F.lit(r"\bEMENTA\b:?(?!\s*(?i:PODER JUDICI))(?!\s*\d{7}-?\d{2}\.?\d{4})(?!\s*\d{15,})")), F.trim(found)).otherwise(c)


def clean_lines(c: Column) -> Column:
    return F.array_join(F.filter(F.transform(F.split(c, "\n"), lambda x: F.trim(x)), lambda x: x != ""), "\n")


def lines_with(c: Column, words: list[str]) -> Column:
    """Stripped lines that hold one of the words, up to and with the first line that holds EMENTA."""
    lines = F.split(c, "\n")
    stop = F.array_position(F.transform(lines, lambda x: F.contains(F.upper(x), F.lit("EMENTA"))), True)
    upto = F.slice(lines, 1, F.when(stop > 0, stop.cast("int")).otherwise(F.size(lines)))
    return F.array_join(F.transform(F.filter(upto, lambda x: F.upper(x).rlike("|".join(words))), lambda x: F.trim(x)), "\n")


def party(c: Column, label: str, ends: list[str]) -> Column:
    """What follows a label up to one of the words that end it; empty if nothing does, null where there is no such label."""
    found = F.regexp_extract(c, rf"(?is){label}: *(.*?)(?:{'|'.join(ends)}|\z)", 1)
    return F.when(c.rlike(f"(?i){label}:"), strip_blanks(found))


def ementa_of_case(c: Column) -> Column:
    """After a line that ends with EMENTA; else the lines that name no party, from the first that isn't blank."""
    marked = F.regexp_replace(F.trim(F.regexp_extract(c, r"(?is)EMENTA[ \t]*\n(.*)$", 1)), r"\n{3,}", "\n\n")
    plain = F.filter(F.split(c, "\n"), lambda x: ~F.upper(x).rlike("APELANTE:|APELADO:|ADVOGADO|AUTOR:|REU:"))
    return F.when(c.rlike(r"(?i)EMENTA[ \t]*\n"), marked).otherwise(F.trim(F.regexp_replace(F.array_join(plain, "\n"), r"^\s+|\s+$", "")))


def topic(c: Column) -> Column:
    """First line that isn't blank and doesn't begin with 'Trata-se', 80 characters, three sentences at most."""
    lines = F.filter(F.transform(F.split(c, "\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.startswith("Trata-se"))
    head = F.left(F.coalesce(F.get(lines, F.lit(0)), F.lit("")), F.lit(80))
    parts = F.split(head, r"\.")
    return F.when(F.size(parts) > 2, F.concat(F.array_join(F.slice(parts, 1, 3), "."), F.lit("."))).otherwise(head)


def replace_broken(c: Column) -> Column:
    """The replacement character as 'a', no NUL."""
    return F.translate(c, "�\x00", "a")


#: Marks around a run of text, and links; each leaves its first group. In this order, as one is made of the other.
INLINE = [r"\*\*([^*]+)\*\*", r"\*([^*]+)\*", r"__([^_]+)__", r"_([^_]+)_", r"\[([^\]]+)\]\([^)]+\)"]
#: Typographic signs and their plain forms.
TYPOGRAPHY = ("•–—“”‘’", "---\"\"''")
RULE = "-" * 50


def markdown_strip(c: Column) -> Column:
    """Plain text of markdown: headings stand alone, lists have dashes, code blocks go, marks around text go, links keep their text."""
    for pattern in INLINE:
        c = F.regexp_replace(c, pattern, "$1")
    # every second piece between fences is code; a fence that nothing closes is text
    pieces = F.split(c, "```")
    open_ended = F.size(pieces) % 2 == 0
    text = F.filter(pieces, lambda x, i: (i % 2 == 0) | (open_ended & (i == F.size(pieces) - 1)))
    kept = F.when(open_ended, F.concat(F.array_join(F.slice(text, 1, F.size(text) - 1), ""), F.lit("```"), F.element_at(text, -1))).otherwise(F.array_join(text, ""))

    def line(x: Column) -> Column:
        own = F.regexp_extract(x, r"^#{1,3}\s+(.+)$", 1)
        bare = F.regexp_replace(x, r"^>\s*", "")
        item = F.regexp_extract(bare, r"^[-*]\s+(.*)$", 1)
        return F.when(own != "", F.concat(F.lit("\n"), own, F.lit("\n"))).when(bare.rlike(r"^[-*]{3,}$"), F.lit(f"\n{RULE}\n")).when(item != "", F.concat(F.lit("- "), item)).otherwise(bare)

    lines = F.array_join(F.transform(F.split(kept, "\n"), line), "\n")
    single = F.regexp_replace(lines, "`([^`]+)`", "$1")
    return trimmed(F.translate(few_blank_lines(single), *TYPOGRAPHY))


def few_blank_lines(c: Column) -> Column:
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def trimmed(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def risk_label(c: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in RISK_LABELS.items() for x in kv]), c), F.lit("Nao avaliado"))


#: Control characters of the old word-processor format, and what stands for them.
CONTROLS = ("\r\x0b\x0c\x07\x1e\xa0\x1f", "\n\n\n\t- ")
#: A field begins, its result begins, it ends.
FIELD = ("\x13", "\x14", "\x15")


def word_controls(c: Column) -> Column:
    """Control characters of the old word-processor format as text; of fields only the results stay, however deep they are nested.

    Pieces between field signs are read once with a stack: text shows where every field around it has come to its result. A text whose
    signs don't pair keeps all its pieces.
    """
    begin, result, end = FIELD
    pieces = F.regexp_extract_all(c, F.lit(f"([{begin}{result}{end}]|[^{begin}{result}{end}]+)"), F.lit(1))
    start = F.struct(F.lit("").alias("out"), F.array().cast("array<boolean>").alias("shown"))

    def step(acc: Column, x: Column) -> Column:
        depth = F.size(acc["shown"])
        above = F.slice(acc["shown"], 1, F.greatest(depth - 1, F.lit(0)))
        shown = F.when(x == begin, F.concat(acc["shown"], F.array(F.lit(False)))).when((x == result) & (depth > 0), F.concat(above, F.array(F.lit(True)))).when(x == end, above).otherwise(acc["shown"])
        text = ~x.isin(*FIELD) & F.forall(acc["shown"], lambda s: s)
        return F.struct(F.when(text, F.concat(acc["out"], x)).otherwise(acc["out"]).alias("out"), shown.alias("shown"))

    def count(sign: str) -> Column:
        return F.length(c) - F.length(F.replace(c, F.lit(sign), F.lit("")))

    fields = F.aggregate(pieces, start, step, lambda acc: acc["out"])
    read = F.when(count(begin) == 0, c).when(count(begin) == count(end), fields).otherwise(c)
    plain = F.regexp_replace(F.translate(read, *CONTROLS), r"[\x00-\x08\x0e-\x1f]", "")
    return trimmed(few_blank_lines(F.regexp_replace(plain, r"[ \t]+\n", "\n")))


def url_strip(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"(?i)(dispon[ií]vel em:?\s*)?https?://\S+", ""), r"[ \t]{2,}", " "))


def snippet(c: Column, terms: list[str], size: int = 800) -> Column:
    """A window around the earliest term, accents and case aside; the beginning if there is none."""
    flat = fold(c)
    spots = F.array(*[F.nullif(F.instr(flat, t), F.lit(0)) for t in terms])
    at = F.array_min(F.filter(spots, lambda x: x.isNotNull())) - 1
    start = F.greatest(F.lit(0), at - size // 3)
    stop = F.least(F.length(c), start + size)
    dots = F.lit(" [...]")
    found = F.concat(F.when(start > 0, F.lit("[...] ")).otherwise(""), F.substring(c, start + 1, stop - start), F.when(stop < F.length(c), dots).otherwise(""))
    none = F.concat(F.left(c, F.lit(size)), F.when(F.length(c) > size, dots).otherwise(""))
    return F.when(at.isNull(), none).otherwise(found)


def date_of(c: Column) -> Column:
    """ISO or day/month/year; null for anything else."""
    return F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), F.try_to_date(c, "dd/MM/yyyy"))


def date_long(c: Column) -> Column:
    """ISO date in words; empty for none; what can't be read as it came."""
    d = F.try_to_date(F.trim(c), "yyyy-MM-dd")
    words = F.concat_ws(" de ", F.dayofmonth(d).cast("string"), F.element_at(F.array(*map(F.lit, MONTHS_PT)), F.month(d)), F.year(d).cast("string"))
    return F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit("")).when(d.isNull(), c).otherwise(words)


def date_es(c: Column) -> Column:
    """'14 de mayo de 2026' as ISO; null if it isn't one."""
    pattern = r"([0-9]{1,2})\s+de\s+([a-zA-Zçéíóú]+)\s+de\s+([0-9]{4})"
    month = F.array_position(F.array(*map(F.lit, MONTHS_ES)), F.lower(F.regexp_extract(c, pattern, 2)))
    return F.when(month > 0, F.concat_ws("-", F.regexp_extract(c, pattern, 3), F.lpad(month.cast("string"), 2, "0"), F.lpad(F.regexp_extract(c, pattern, 1), 2, "0")))


def citation(case: Column, date: Column, series: Column, number: Column, paragraph: Column, stage: Column, kind: Column, url: Column) -> Column:
    """Canonical citation; each missing part is left out by itself."""
    words = date_long(date)

    def dated(label: Column) -> Column:
        return F.when(words != "", F.concat(label, F.lit(" de "), words, F.lit("."))).otherwise(F.concat(label, F.lit(".")))

    def sentence(c: Column) -> Column:
        return F.concat(F.trim(c), F.lit("."))

    staged = F.when(F.coalesce(F.trim(stage), F.lit("")) != "", sentence(stage))
    year = F.when(F.length(date) >= 4, F.substring(date, 3, 2)).otherwise("00")
    name = F.when(kind == "OC", sentence(case)).otherwise(F.concat(F.lit("Caso "), sentence(case)))
    act = (
        F.when(kind == "OC", F.concat_ws(" ", staged, dated(F.concat(F.lit("Parecer Consultivo OC-"), F.coalesce(number.cast("string"), F.lit("")), F.lit("/"), year))))
        .when(kind.isin("SS", "PS"), F.concat_ws(" ", F.lit("Supervisão de Cumprimento de Sentença."), dated(F.lit("Resolução"))))
        .when(kind == "CC", F.concat_ws(" ", staged, dated(F.lit("Sentença"))))
        .otherwise(F.concat_ws(" ", staged, dated(F.lit("Decisão")), F.concat(F.lit("[tipo "), kind, F.lit(" — rótulo canônico não definido]"))))
    )
    filed = F.concat_ws(" ", F.when(F.coalesce(series, F.lit("")) != "", F.concat(F.lit("Série "), series)), F.when(number.isNotNull(), F.concat(F.lit("No. "), number.cast("string"))))
    par = paragraph.cast("string")
    tail = F.when(filed != "", F.concat(filed, F.when(par.isNotNull(), F.concat(F.lit(", par. "), par)).otherwise(""), F.lit("."))).when(par.isNotNull(), F.concat(F.lit("Par. "), par, F.lit(".")))
    link = F.when(F.coalesce(F.trim(url), F.lit("")) != "", F.concat(F.lit("Disponível em: "), F.trim(url)))
    return F.concat_ws(" ", F.lit("Corte IDH."), name, act, tail, link)


def state_of_case(c: Column) -> Column:
    """Country after the last 'Vs.'; null where it can't be one."""
    parts = F.split(c, r"\s+Vs\.\s+")
    state = F.trim(F.regexp_replace(F.trim(F.element_at(parts, -1)), r"\.+$", ""))
    return F.when((F.size(parts) > 1) & (state != "") & (F.length(state) <= 40) & ~state.rlike("[0-9]"), state)


def core_name(c: Column) -> Column:
    bare = F.regexp_replace(F.trim(c), r"(?i)^\s*caso\s+", "")
    return F.regexp_replace(F.get(F.split(bare, r"(?i)\s+vs\.\s+", 2), F.lit(0)), r"^[ .]+|[ .]+$", "")


def name_terms(c: Column, stop: list[str], most: int = 4) -> Column:
    """The first significant words of a case name."""
    words = F.split(core_name(c), r"[^0-9A-Za-zÀ-ÿ]+")
    return F.slice(F.filter(words, lambda w: (F.length(w) > 1) & ~fold(w).isin(stop)), 1, most)


#: Language codes that end the name of a document's file.
FILE_LANGUAGES = ["por", "esp", "es", "ing", "eng", "fra", "fre"]


def url_of_language(c: Column, language: str) -> Column:
    """The same document in another language; null if the address has no language suffix."""
    name = F.lower(F.substring_index(c, "_", -1))
    number = F.regexp_extract(name, r"^[a-z]+([0-9]*)\.pdf$", 1)
    code = F.regexp_extract(name, r"^([a-z]+)[0-9]*\.pdf$", 1)
    stem = F.substring(c, F.lit(1), F.length(c) - F.length(name))
    return F.when(F.contains(c, F.lit("_")) & code.isin(*FILE_LANGUAGES), F.concat(stem, F.lit(language), number, F.lit(".pdf")))


def host_norm(c: Column) -> Column:
    return F.regexp_replace(c, r"(?i)^https?://(www\.)?", "https://www.")


def cnj_format(c: Column) -> Column:
    """Twenty digits in the official grouping; empty for anything else."""
    return F.when(c.rlike(r"^\d{20}$"), F.regexp_replace(c, r"^(\d{7})(\d{2})(\d{4})(\d)(\d{2})(\d{4})$", "$1-$2.$3.$4.$5.$6")).otherwise("")


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def is_cnj(c: Column) -> Column:
    return c.rlike(f"^{CNJ}$")


#: Abbreviations of appeal classes, and the words that join them.
APPEAL_CLASSES = ["REsp", "AREsp", "EREsp", "AgInt", "AgRg", "EDcl", "EAREsp", "HC", "RHC", "RMS", "MS", "CC", "Rcl", "Pet", "SLS", "SS", "AR", "PUIL", "IAC", "EDv", "RE", "AI", "Ag", "no", "nos", "na", "nas"]


def process_number(c: Column) -> Column:
    """Digits of a query that is an appeal number and nothing else."""
    words = F.filter(F.split(F.regexp_replace(F.trim(c), r"\s*/\s*([A-Za-z]{2})$", ""), r"\s+"), lambda w: w != "")
    last = F.element_at(F.when(F.size(words) > 0, words), -1)
    classes = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w: F.lower(F.regexp_replace(w, r"\.$", "")))
    known = F.forall(classes, lambda w: w.isin(*[x.lower() for x in APPEAL_CLASSES]))
    grouped = last.rlike(r"^\d{1,3}([.]\d{3})+$") | last.rlike(r"^\d{4,8}$")
    return F.when(known & grouped, digits(last))


#: Spellings of a law's type, letters only, and the index's prefix for it.
LAW_PREFIXES = {
    "DECRETO LEI": "DEL",
    "DECRETOLEI": "DEL",
    "DEL": "DEL",
    "LEI COMPLEMENTAR": "LCP",
    "LCP": "LCP",
    "LC": "LCP",
    "MEDIDA PROVISORIA": "MPR",
    "MPV": "MPR",
    "MPR": "MPR",
    "MP": "MPR",
    "DECRETO": "DEC",
    "DEC": "DEC",
    "LEI": "LEI",
}
# Spellings of "number" before one.
NUMBER_SIGNS = ["Nº", "N°", "NO", "N", "Nº.", "N°.", "NO.", "N."]


def law_norm(c: Column) -> Column:
    """A law's type and number as the index spells them; null if not understood.

    Before the first digit stand the words of the type, parted by blanks or hyphens, and perhaps a sign of number; the digits and points
    from there are the number. Words that are joined by other signs, or run on, are none that is known.
    """
    first = F.regexp_instr(c, F.lit("[0-9]"))
    words = F.filter(F.split(F.upper(fold(F.substring(c, F.lit(1), first - 1))), r"[\s-]+"), lambda w: w != "")
    signed = F.coalesce(F.try_element_at(words, F.lit(-1)).isin(NUMBER_SIGNS), F.lit(False))
    kind = F.array_join(F.when(signed & (F.size(words) > 1), F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))).otherwise(words), " ")
    spelled = F.create_map(*[F.lit(x) for pair in LAW_PREFIXES.items() for x in pair])
    prefix = F.try_element_at(spelled, F.rtrim(kind, F.lit(".")))
    number = F.ltrim(F.replace(F.regexp_extract(c, "([0-9][0-9.]*)", 1), F.lit("."), F.lit("")), F.lit("0"))
    return F.when((first > 0) & (number != ""), F.concat(prefix, F.lit("-"), number))


def search_key(c: Column) -> Column:
    """Canonical form of a search: folded, plain signs only; words sorted and unique unless their order means something."""
    ordered = c.rlike(r'(?i)["()]|(^|\s)(e|ou|and|or|nao|não|not|adj\d*|prox\d*|com\d*|mesmo\d*)(\s|$)|(^|\s)-\S')
    plain = F.translate(c, ACCENTED + ACCENTED.upper(), PLAIN + PLAIN.upper())
    words = F.filter(F.split(F.regexp_replace(plain, r"[^0-9A-Za-z\s*$+\-]", " "), r"\s+"), lambda w: w != "")
    words = F.transform(words, lambda w: F.when(w.isin("E", "OU", "NAO", "AND", "OR", "NOT"), w).otherwise(F.lower(w)))
    return F.when(c.rlike(r"^\s*$"), c).otherwise(F.array_join(F.when(ordered, words).otherwise(F.array_sort(F.array_distinct(words))), " "))


#: Fields of a request that hold an expression of search.
SEARCH_FIELDS = ["query", "busca", "buscaGeral", "termo", "termos", "livre", "texto"]


def canonical_request(c: Column) -> Column:
    """A JSON text in canonical form: fields sorted at any depth, no blanks, searches by ``search_key``; null if it isn't JSON.

    As a VARIANT its objects are kept sorted. In the text that this prints a quote within a value is always escaped, so the name
    of a field between bare quotes is a name, and the text is cut before each.
    """
    names = "|".join(SEARCH_FIELDS)
    pieces = F.split(F.to_json(F.try_parse_json(c)), f'(?="(?:{names})":")')

    def piece(x: Column) -> Column:
        head = F.regexp_extract(x, f'^("(?:{names})":)"', 1)
        raw = F.regexp_extract(x, f'^"(?:{names})":("(?:[^"\\\\]|\\\\.)*+")', 1)
        value = F.try_variant_get(F.try_parse_json(F.nullif(raw, F.lit(""))), "$", "string")
        key = F.to_json(F.to_variant_object(F.struct(search_key(value).alias("v"))))
        printed = F.substring(key, F.lit(6), F.length(key) - 6)
        return F.when((head != "") & value.isNotNull(), F.concat(head, printed, F.substring(x, F.length(head) + F.length(raw) + 1, F.length(x)))).otherwise(x)

    return F.array_join(F.transform(pieces, piece), "")


def request_key(c: Column) -> Column:
    """Key of a request in a cache: equal for requests that ask the same."""
    return F.sha2(canonical_request(c), 256)


def sanitize_query(c: Column) -> Column:
    """struct(query, removed): refused signs as blanks, and which there were."""
    pattern = r"[#!+';_\-|]"
    removed = F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1))))
    return F.struct(F.when(F.size(removed) > 0, collapse(F.regexp_replace(c, pattern, " "))).otherwise(c).alias("query"), removed.alias("removed"))


def sanitize_xml(c: Column) -> Column:
    return F.replace(c, F.lit("--"), F.lit("—"))


def xml_escape(c: Column) -> Column:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(sign), F.lit(name))
    return c


def latin1_typography(c: Column) -> Column:
    return F.translate(c, "“”‘’–—", "\"\"''--")


def suspect(c: Column) -> Column:
    """A footnote's citation mark leaked into the text."""
    return c.rlike(r"\bCfr?\.")


#: The words that begin a results line and its page count.
RESULTS_LINE = ("Exibindo", "Página:")


def pagination(c: Column) -> Column:
    """struct(first, last, total, page, pages) of a results line; nulls if there is none: the numbers after each of its words."""
    shown, page = (F.regexp_extract(c, f"{w}([^\\p{{L}}]*(?:de[^\\p{{L}}]*)?)", 1) for w in RESULTS_LINE)
    numbers = F.concat(*[F.transform(F.regexp_extract_all(x, F.lit("([0-9][0-9.]*)"), F.lit(1)), lambda n: F.replace(n, F.lit("."), F.lit(""))) for x in (shown, page)])
    names = ["first", "last", "total", "page", "pages"]
    return F.struct(*[F.when(F.size(numbers) == len(names), F.get(numbers, i)).cast("bigint").alias(n) for i, n in enumerate(names)])


def fold_entities(c: Column) -> Column:
    bare = F.regexp_replace(c, "<[^>]+>", " ")
    return F.regexp_replace(F.translate(fold(unescape(bare)), "’‘‐‑", "''--"), r"\s+", " ")


def title_parts(c: Column) -> Column:
    """struct(name, stage) of a catalogue title of a contentious case; nulls where they can't be told."""
    body = F.regexp_replace(collapse(c), r"(?i)^corte idh\.\s*", "")
    pattern = r"^Caso\s+(.+?\s+Vs\.\s+[^.]+)\.\s*(.*)$"
    rest = F.regexp_extract(body, pattern, 2)
    stage = F.regexp_replace(F.trim(F.regexp_extract(rest, r"^(.+?)\s*(?:Sentencia|Resolución)\s", 1)), r"[.,]+$", "")
    return F.struct(F.nullif(F.regexp_extract(body, pattern, 1), F.lit("")).alias("name"), F.nullif(stage, F.lit("")).alias("stage"))


def list_header(paragraphs: Column) -> Column:
    """struct(turma, sessao, gabinete) of a list of cases: what its first five paragraphs tell, the last of them where several do.

    A cabinet's label begins its paragraph or follows a dash, and label and title are whole words: syllables of running text are no label.
    """
    head = F.slice(paragraphs, 1, 5)

    def last(pattern: str, upper: bool = True) -> Column:
        told = F.transform(head, lambda p: trimmed(F.regexp_extract(F.upper(p) if upper else p, pattern, 1)))
        return F.get(F.reverse(F.filter(told, lambda x: x != "")), F.lit(0))

    return F.struct(
        F.concat(last(r"(\d+)ª?\s*TURMA"), F.lit("ª Turma")).alias("turma"),
        last(r"SESS[ÃA]O[^:]*:\s*(\d{2}/\d{2}/\d{4})").alias("sessao"),
        last(r"(?i)(?:^|-)\s*GAB(?:INETE)?(?!\p{L})[^-]*-?\s*(?<!\p{L})(?=DES(?:A|EMBARGADORA?)?(?!\p{L}))(DES\.?\s*[\p{L}\s]+)", upper=False).alias("gabinete"),
    )


def leading_number(c: Column) -> Column:
    """The whole number that a text begins with; 0 for text that begins with none, or that is too large or null."""
    return F.coalesce(F.regexp_extract(c, r"^\s*([+-]?[0-9]+)", 1).try_cast("bigint"), F.lit(0))
