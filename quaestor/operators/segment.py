"""Cutting texts into records: session lists into cases, judgments into numbered paragraphs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

_OPEN = re.compile(r"[ \t]*([0-9]{1,3})\.[ \t]+(.*)$")
_NOTE = re.compile(r"[ \t]*[0-9]{1,3}[ \t]+(\S.*)$")
_LONE = re.compile(r"[ \t]*[0-9]{1,3}[ \t]*$")
_PAGE = re.compile(r"[ \t]*-[ \t]*[0-9]+[ \t]*-[ \t]*$")
_CITES = re.compile(r"Cfr?\.")
_URL = re.compile(r"(?:Dispon[ií]vel em:?\s*)?https?://\S+", re.I)


def is_title(line: str) -> bool:
    return any(c.isalpha() for c in line) and not any(c.islower() for c in line)


def numbered_paragraphs(text: str | None) -> list[tuple[int, str, list[str]]]:
    """(number, body, removed titles) of a judgment.

    Only the next expected number opens a paragraph, so list items and stray numbers are body. A footnote (a number without
    a full stop after a blank line, or before a citation) costs its one line, a lone number its line, and the next if that
    cites. Two or more upper-case lines that a blank line, a note or a paragraph ends are a title; any other go back.
    """
    found: list[tuple[int, list[str], list[str]]] = []
    pending: list[str] = []
    lines = (text or "").splitlines()

    def settle(title: bool) -> None:
        if pending and found:
            if title and len(pending) > 1:
                found[-1][2].append(" ".join(pending))
            else:
                found[-1][1].extend(pending)
        pending.clear()

    blank, skip = True, False
    for i, line in enumerate(lines):
        if skip:
            skip, blank = False, False
            continue
        bare = line.strip()
        opened = _OPEN.match(line)
        note = _NOTE.match(line)
        if _PAGE.match(line):
            blank = False
        elif opened and int(opened[1]) == len(found) + 1:
            settle(True)
            found.append((len(found) + 1, [opened[2]], []))
            blank = False
        elif note and (blank or _CITES.match(note[1])):
            settle(True)
            blank = False
        elif bare and _LONE.match(line):
            settle(True)
            skip = i + 1 < len(lines) and bool(_CITES.match(lines[i + 1].strip()))
            blank = False
        elif not bare:
            settle(True)
            blank = True
        elif is_title(bare):
            pending.append(bare)
            blank = False
        else:
            settle(False)
            if found:
                found[-1][1].append(bare)
            blank = False
    settle(True)
    return [(n, re.sub(r"[ \t]{2,}", " ", _URL.sub("", " ".join(" ".join(parts).split()))).strip(), titles) for n, parts, titles in found]


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, number, body, titles); a state machine over a text's lines, so a map pass in Python."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, *p) for i, t in zip(batch["id"], batch["text"], strict=True) for p in numbered_paragraphs(t)]
            yield pd.DataFrame(rows, columns=["id", "number", "body", "titles"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, "id bigint, number int, body string, titles array<string>")


def cases_lenient(body: Column) -> Column:
    """array<struct(ordem, numero, tipo, conteudo)>: headers anywhere, hyphen or dash, type up to a line's end or PODER."""
    head = rf"(\d+)\s*[-–]\s*({T.CNJ})\s*[-–]\s*([\p{{L}}\s/]+?)(?=\n|PODER)"
    pieces = F.filter(F.split(body, rf"(?=\b\d+\s*[-–]\s*{T.CNJ}\s*[-–]\s*[\p{{L}}])"), lambda p: p.rlike("^" + head))
    return F.transform(pieces, lambda p: F.struct(F.regexp_extract(p, head, 1).cast("int").alias("ordem"), F.regexp_extract(p, head, 2).alias("numero"), F.trim(F.regexp_extract(p, head, 3)).alias("tipo"), F.regexp_replace(p, "^" + head, "").alias("conteudo")))


def cases_strict(body: Column) -> Column:
    """array<struct(ordem, numero, tipo, ementa)>: headers fill a line; text counts only after a line that is EMENTA."""
    head = rf"(\d+)\s*-\s*({T.CNJ})\s*-\s*(.+)"
    pieces = F.filter(F.split(body, rf"(?m)(?=^\d+\s*-\s*{T.CNJ}\s*-\s*.)"), lambda p: p.rlike("^" + head))
    ementa = r"(?is)\n[ \t]*EMENTA[ \t]*\n(.*)$"
    return F.transform(pieces, lambda p: F.struct(F.regexp_extract(p, "^" + head, 1).cast("int").alias("ordem"), F.regexp_extract(p, "^" + head, 2).alias("numero"), F.trim(F.regexp_extract(p, "^" + head, 3)).alias("tipo"), T.clean_lines(F.regexp_extract(p, ementa, 1)).alias("ementa")))
