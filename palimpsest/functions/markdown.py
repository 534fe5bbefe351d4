"""Markdown to HTML, as far as metadata uses it: headings, paragraphs, lists, tables, fences, links and emphasis."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import escape, unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_inline_rules = [
    (re.compile(r"`([^`]+)`"), r"<code>\1</code>"),
    (re.compile(r"!\[([^\]]*)\]\(([^)\s]+)\)"), r'<img alt="\1" src="\2">'),
    (re.compile(r"\[([^\]]+)\]\(([^)\s]+)\)"), r'<a href="\2">\1</a>'),
    (re.compile(r"\*\*(.+?)\*\*"), r"<strong>\1</strong>"),
    (re.compile(r"\*(.+?)\*"), r"<em>\1</em>"),
]


def inline(text: str) -> str:
    out = escape(text, False)
    for rule, made in _inline_rules:
        out = rule.sub(made, out)
    return re.sub(r'href="/?miscellaneous/', 'href="/static/data/miscellaneous/', out)


def _cells(row: str) -> list[str]:
    return [c.strip() for c in row.strip().strip("|").split("|")]


def _block(lines: list[str]) -> str:
    if all(re.match(r"[-*] ", x) for x in lines):
        return "<ul>" + "".join(f"<li>{inline(x[2:].strip())}</li>" for x in lines) + "</ul>"
    if len(lines) > 1 and "|" in lines[0] and re.fullmatch(r"[\s|:-]+", lines[1]):
        head = "".join(f"<th>{inline(c)}</th>" for c in _cells(lines[0]))
        body = "".join("<tr>" + "".join(f"<td>{inline(c)}</td>" for c in _cells(x)) + "</tr>" for x in lines[2:])
        return f"<table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>"
    return f"<p>{inline(chr(10).join(lines))}</p>"


def render(text: str) -> str:
    out: list[str] = []
    waiting: list[str] = []
    fence: list[str] | None = None

    def flush() -> None:
        if waiting:
            out.append(_block(list(waiting)))
            waiting.clear()

    for line in text.split("\n"):
        if line.startswith("```"):
            flush()
            if fence is None:
                fence = []
            else:
                out.append(f"<pre><code>{escape(chr(10).join(fence), False)}</code></pre>")
                fence = None
        elif fence is not None:
            fence.append(line)
        elif m := re.match(r"(#{1,6}) (.+)$", line):
            flush()
            out.append(f"<h{len(m[1])}>{inline(m[2].strip())}</h{len(m[1])}>")
        elif not line.strip():
            flush()
        else:
            if waiting and bool(re.match(r"[-*] ", line)) != bool(re.match(r"[-*] ", waiting[0])):
                flush()
            waiting.append(line)
    if fence is not None:
        out.append(f"<pre><code>{escape(chr(10).join(fence), False)}</code></pre>")
    flush()
    return "\n".join(out)


def sections_html(sections: DataFrame, allowed: list[str] | None = None) -> DataFrame:
    """(doc_id, ord, field, html) of metadata sections, of the allowed fields alone if some are named."""
    kept = sections.where(sections["field"].isin(allowed)) if allowed else sections

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = ["\n".join(f"- {x}" for x in i) if k == "list" else (v or "") for k, v, i in zip(b["kind"], b["value"], b["items"], strict=True)]
            yield b[["doc_id", "ord", "field"]].assign(html=[render(t) for t in texts])

    ident = sections.schema["doc_id"].dataType.simpleString()
    return kept.select("doc_id", "ord", "field", "kind", "value", "items").mapInPandas(run, f"doc_id {ident}, ord bigint, field string, html string")


def entries(sections: DataFrame) -> DataFrame:
    """(doc_id, entries, mapping) of metadata sections, as JSON: what a reader shows, and how book pages map to scanned ones.

    A section of one paragraph without markup is inline text, others are HTML; empty ones don't show, nor does the page
    offset. The mapping has the link of the first edition PDF, unless that says that there is none, and pairs of pages.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, given in zip(b["doc_id"], b["given"], strict=True):
                shown, link, offsets = [], None, None
                for field, kind, value, items in ((r["field"], r["kind"], r["value"], r["items"]) for r in given):
                    listed = list(items) if kind == "list" else []
                    html = render("\n".join(f"- {x}" for x in listed) if listed else (value or ""))
                    plain = re.fullmatch(r"<p>([^<]*)</p>", html)
                    if field == "Edition PDFs" and not plain:
                        first = re.search(r"<li>(.*?)</li>", html)
                        found = re.search(r'<a href="([^"]*)"', html)
                        if found and not (first and re.sub("<[^>]+>", "", first[1]).strip().startswith("No ")):
                            link = unescape(found[1])
                    if field == "PDF Page Offset":
                        if not plain:
                            pairs = [[p.strip() for p in x.split("→" if "→" in x else ",")] for x in listed]
                            offsets = [[int(p) for p in pair] for pair in pairs if len(pair) == 2 and all(re.fullmatch(r"[+-]?\d+", p) for p in pair)]
                    elif html:
                        shown.append({"type": "field", "label": field or None, "inline_text": unescape(plain[1]).strip() if plain else None, "content_html": "" if plain else html})
                mapping = {"url": link, "offsets": offsets or [[1, 1]]} if link else None
                rows.append((doc, json.dumps(shown, ensure_ascii=False), json.dumps(mapping, ensure_ascii=False) if mapping else None))
            yield pd.DataFrame(rows, columns=["doc_id", "entries", "mapping"])

    ordered = F.array_sort(F.collect_list(F.struct("ord", "field", "kind", "value", "items")))
    ident = sections.schema["doc_id"].dataType.simpleString()
    return sections.groupBy("doc_id").agg(ordered.alias("given")).mapInPandas(run, f"doc_id {ident}, entries string, mapping string")
