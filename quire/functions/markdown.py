"""A small block grammar of Markdown: segments, block references, and a canonical form.

It knows the seven segment types that the operators tell apart, not all of CommonMark. ``segments`` and ``block_refs`` map one
text to many rows and run as Arrow-mapped generators.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.schemas import SEGMENT

HEADING = re.compile(r"^ {0,3}(#{1,6})(?:[ \t]+(.*?))?(?:[ \t]+#+)?[ \t]*$")
FENCE = re.compile(r"^ {0,3}(`{3,}|~{3,})(.*)$")
BULLET = re.compile(r"^ {0,3}(?:[-*+]|\d{1,9}[.)])(?:[ \t]+|$)")
RULE = re.compile(r"^ {0,3}(?:(?:\*[ \t]*){3,}|(?:-[ \t]*){3,}|(?:_[ \t]*){3,})$")
HTML = re.compile(r"^ {0,3}<(?:!--|/?[A-Za-z])")
DELIMITER = re.compile(r"^ {0,3}\|?[ \t]*:?-+:?[ \t]*(?:\|[ \t]*:?-+:?[ \t]*)*\|?[ \t]*$")
IMAGE = re.compile(r"!\[([^\]]*)\]\(([^)\s]+)[^)]*\)")
HTML_IMAGE = re.compile(r"<img\s[^>]*src=[\"']([^\"']+)[\"']", re.IGNORECASE)


def plain(text: str) -> str:
    return " ".join(unicodedata.normalize("NFKC", text).split())


def _fence_end(lines: list[str], at: int) -> int:
    """The line after a fenced block."""
    mark = FENCE.match(lines[at])[1]
    for i in range(at + 1, len(lines)):
        s = lines[i].strip()
        if len(s) >= len(mark) and not s.strip(mark[0]):
            return i + 1
    return len(lines)


def parse(text: str) -> list[tuple[str, str, int, int, str]]:
    """(type, text, first line, line after the last, source) of each segment; a list gives itself and its items' paragraphs."""
    lines, out, i = (text or "").splitlines(), [], 0

    def add(kind, content, a, b):
        out.append((kind, content, a, b, "\n".join(lines[a:b])))

    def interrupts(k):
        line = lines[k]
        return not line.strip() or HEADING.match(line) or FENCE.match(line) or BULLET.match(line) or RULE.match(line) or HTML.match(line)

    while i < len(lines):
        line, start = lines[i], i
        if not line.strip():
            i += 1
        elif FENCE.match(line):
            i = _fence_end(lines, i)
            closed = i - start > 1 and FENCE.match(lines[i - 1]) is not None
            add("code", "".join(x + "\n" for x in lines[start + 1 : i - closed]), start, i)
        elif h := HEADING.match(line):
            i += 1
            add("heading", (h[2] or "").strip(), start, i)
        elif RULE.match(line):
            i += 1
        elif BULLET.match(line):
            items: list[list[str]] = []
            while i < len(lines) and (lines[i].strip() or (i + 1 < len(lines) and (BULLET.match(lines[i + 1]) or lines[i + 1].startswith("  ")))):
                if not BULLET.match(lines[i]) and lines[i].strip() and (HEADING.match(lines[i]) or FENCE.match(lines[i])):
                    break
                if BULLET.match(lines[i]):
                    items.append([BULLET.sub("", lines[i]).strip()])
                elif lines[i].strip():
                    items[-1].append(lines[i].strip())
                i += 1
            texts = ["\n".join(filter(None, item)) for item in items]
            add("list", "\n".join(texts), start, i)
            for t in texts:
                if t:
                    out.append(("paragraph", t, start, i, t))
        elif line.startswith("    ") or line.startswith("\t"):
            while i < len(lines) and (lines[i].startswith(("    ", "\t")) or not lines[i].strip()):
                i += 1
            while not lines[i - 1].strip():
                i -= 1
            add("code", "".join(re.sub(r"^( {4}|\t)", "", x) + "\n" for x in lines[start:i]), start, i)
        elif HTML.match(line):
            while i < len(lines) and lines[i].strip():
                i += 1
            add("html_block", "\n".join(lines[start:i]), start, i)
        elif "|" in line and i + 1 < len(lines) and DELIMITER.match(lines[i + 1]) and "-" in lines[i + 1]:
            i += 2
            while i < len(lines) and lines[i].strip() and "|" in lines[i]:
                i += 1
            add("table", "\n".join(lines[start:i]), start, i)
        else:
            i += 1
            while i < len(lines) and not interrupts(i):
                i += 1
            body = "\n".join(x.strip() for x in lines[start:i])
            images = IMAGE.findall(body)
            for _, source in images:
                add("image", source, start, i)
            if not images:
                add("paragraph", body, start, i)
    return out


def canonical(text: str, passes: int = 8) -> str:
    """Canonical form: one blank line between blocks, no space at line ends, `-` bullets, pipe rows with single spaces. A text that
    does not settle within some passes stays as it is, so the form of a form is itself."""
    now = text
    for _ in range(passes):
        after = _pass(now)
        if after == now:
            return now
        now = after
    return text


def _pass(text: str) -> str:
    blocks, last = [], -1
    for kind, _, _, b, raw in parse(text):
        if b <= last:  # an item of the list before it, or a second image of a paragraph
            continue
        last = b
        if kind == "code" or kind == "html_block":
            blocks.append(raw.rstrip())
        elif kind == "table":
            rows = [r.strip().strip("|").split("|") for r in raw.replace("\\|", "\0").splitlines()]
            width = len(rows[0])
            cells = [[c.strip() for c in r[:width]] + [""] * (width - len(r)) for r in rows]
            cells[1] = [(":" if c.startswith(":") else "") + "---" + (":" if c.endswith(":") and len(c) > 1 else "") for c in cells[1]]
            blocks.append("\n".join("| " + " | ".join(r) + " |" for r in cells).replace("\0", "\\|"))
        elif kind == "list":
            blocks.append("\n".join(re.sub(r"^( *)[*+] +", r"\1- ", x.rstrip()) for x in raw.splitlines() if x.strip()))
        elif kind == "heading":
            h = HEADING.match(raw)
            blocks.append(f"{h[1]} {(h[2] or '').strip()}".rstrip())
        else:
            blocks.append("\n".join(x.strip() for x in raw.splitlines()))
    return "\n\n".join(blocks) + "\n" if blocks else ""


@F.pandas_udf(T.StringType())
def normalize_markdown(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else canonical(t))


def block_refs(text: str) -> list[tuple[str, str, str | None, str]]:
    """(type, text, asset, hash of the plain text) by lines: headings, fences, images alone on a line, pipe tables, paragraphs."""
    lines, out, i = (text or "").split("\n"), [], 0

    def add(kind, body, asset=None):
        out.append((kind, body, asset, hashlib.sha256(plain(body).encode()).hexdigest()))

    starts = lambda s: re.match(r"^#{1,6}\s+.+$", s) or re.match(r"^(?:`{3,}|~{3,})", s) or s.strip().startswith("|")
    while i < len(lines):
        line, a = lines[i], i
        if not line.strip():
            i += 1
        elif re.match(r"^#{1,6}\s+.+$", line):
            i += 1
            add("heading", line)
        elif mark := re.match(r"^(`{3,}|~{3,})", line):
            i += 1
            while i < len(lines):
                s = lines[i].strip()
                i += 1
                if s.startswith(mark[1][:3]) and len(s) >= len(mark[1]):
                    break
            add("code", "\n".join(lines[a:i]))
        elif (found := re.match(r"!\[[^\]]*\]\(([^)]+)\)", line.strip())) or (found := HTML_IMAGE.match(line.strip())):
            i += 1
            add("image", line, found[1])
        elif line.strip().startswith("|"):
            while i < len(lines) and lines[i].strip().startswith("|"):
                i += 1
            add("table", "\n".join(lines[a:i]))
        else:
            i += 1
            while i < len(lines) and lines[i].strip() and not starts(lines[i]):
                i += 1
            add("paragraph", "\n".join(lines[a:i]))
    return out


def _rows(df: DataFrame, keys: list[str], column: str, fields: str, work) -> DataFrame:
    kept = df.select(*keys, F.col(column).alias("__text"))
    schema = ", ".join(f"{k} {kept.schema[k].dataType.simpleString()}" for k in keys) + ", " + fields

    def run(batches):
        for pdf in batches:
            rows = [(*key, n, *found) for *key, text in pdf.itertuples(index=False, name=None) for n, found in enumerate(work(text), start=1)]
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])

    return kept.mapInPandas(run, schema)


def segments(df: DataFrame, keys: list[str], column: str = "markdown") -> DataFrame:
    """One row a segment of each text: keys, ordinal, segment_type, text, line_start, line_end, raw."""
    return _rows(df, keys, column, SEGMENT, parse)


def references(df: DataFrame, keys: list[str], column: str = "markdown") -> DataFrame:
    """One row a block reference: keys, ordinal, block_type, markdown, asset_ref, normalized_text_hash."""
    return _rows(df, keys, column, "ordinal int, block_type string, markdown string, asset_ref string, normalized_text_hash string", block_refs)
