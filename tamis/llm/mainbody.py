"""The lines of a page's main body, by a vote on container paths per host.

A page is read once, line by line, into its tree of containers: block elements, and in flat pages the stretches between a rule
and the comment that ends them; a line that holds several elements is read element by element. Every container gets a score out
of its own lines (prose and facts count for it, links and controls against it, the page's own name as a heading is worth most, any
main heading something). The best container of each page has one vote on its host, for its path as written and for the path
without classes; the path that wins on a host names the container from which each of its pages is taken.
"""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata
from urllib.parse import unquote, urlsplit

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.session import broadcast_if_small, checkpoint

#: Elements that make a container if no text follows their tag in its line; lists and rows belong to the container around them.
BLOCKS = ("div", "section", "main", "nav", "aside", "footer", "header", "table", "form", "article", "dialog", "fieldset", "body")
#: What the page's name as a heading, or any main heading, is worth in letters, and what a link or a control costs.
NAME_WORTH, HEADING_WORTH, LINK_COST, CONTROL_COST = 1500, 300, 60, 80
#: A path as written wins over the path without classes if it has this share of the latter's votes.
SPECIFIC_SHARE = 0.6
#: Score from which a container without any heading and off its host's path is still a main body; share of lines known from pages
#: of error statuses from which a page that doesn't carry its own name is one too; hosts on which such a line must have stood.
PROSE_WORTH, ERROR_SHARE, ERROR_HOSTS = 400, 0.5, 2
#: Lines whose reading a worker remembers, since the pages of a host share most of them.
MEMORY_LINES = 100_000

_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<!--(.*?)-->|<!--|<![^>]*>", re.S)
_ANCHOR = re.compile(r"<a\b[^>]*>.*?</a\s*>", re.S | re.I)
_CLASS = re.compile(r"class\s*=\s*[\"']([^\"']*)[\"']", re.I)
_SPACE = regex.compile(r"[\s\u00a0\u200b]+")
_CRUMB = regex.compile(r"^[^/›»>|]{1,60}(?:\s[/›»>|]\s[^/›»>|]{1,80}){1,6}$")
_NAME = regex.compile(r"[^\p{L}\p{N}]+")
_WORD = regex.compile(r"[\p{L}\p{N}]")
_CONTROL = re.compile(r"<(?:button|input|select|option|label)\b", re.I)
_HEADING = re.compile(r"<h1\b", re.I)
_PROSE = re.compile(r"[.!?。！？:]")
_BLOCK_OPEN = re.compile(r"<(?:" + "|".join(BLOCKS) + r")\b", re.I)
_PART = re.compile(r"<(?:p|li|h[1-6]|tr|dt|dd)\b", re.I)
_EDGE = re.compile(r"(?=<(?:" + "|".join(BLOCKS) + r"|p|li|h[1-6]|tr|dt|dd|hr)\b)|(?<=>)(?=</(?:" + "|".join(BLOCKS) + r")\b)", re.I)
_AFTER = re.compile(r"(</(?:" + "|".join(BLOCKS) + r"|p|li|h[1-6]|tr|dt|dd)\s*>)(?=.)", re.I | re.S)
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.S | re.I)
_ENDS = {"!": re.compile("-->")} | {x: re.compile(rf"</{x}\s*>", re.I) for x in ("script", "style", "head", "template", "noscript", "svg")}
#: What pages say that stand for a missing page or a failure, in the languages of the trade.
_ERROR = regex.compile(
    r"\b404\b|not found|does ?n[o']t exist|no longer exists|went wrong|checking your browser|access denied|nicht gefunden|gibt es (?:leider )?nicht|introuvable|n['’]existe (?:pas|plus)|no encontrad[ao]|no existe|ya no existe"
    r"|non trovat[ao]|non esiste|não encontrad[ao]|não existe|niet gevonden|bestaat niet|hittades inte|finns inte|찾을 수 없|존재하지 않|見つかりません|存在しません|削除され",
    regex.I,
)


def visible(line: str) -> str:
    """Text of a line without tags, entities resolved, blanks made one."""
    return _SPACE.sub(" ", html.unescape(_TAG.sub("", line))).strip()


def elements(line: str) -> list[str]:
    """A line cut at the edges of its elements if it holds more than one, as in pages without line ends; else the line itself."""
    if line.count("<") < 4 or len(_BLOCK_OPEN.findall(line)) + len(_PART.findall(line)) < 2 or not _BLOCK_OPEN.search(line):
        return [line]
    return [x for part in _AFTER.sub("\\1\n", line).split("\n") for x in _EDGE.split(part) if x]


def name_key(text: str) -> str:
    t = unicodedata.normalize("NFKD", text.lower())
    return _NAME.sub("", "".join(c for c in t if not unicodedata.combining(c)))


def page_names(url: str | None, title: str | None) -> set[str]:
    """Keys by which a page may call itself in its heading: the title without the site's name, and the last part of its URL."""
    out = set()
    if title:
        out.add(name_key(regex.split(r"\s[|–—·-]\s", title)[0]))
    try:
        last = unquote(urlsplit(url or "").path.rstrip("/").rsplit("/", 1)[-1])
    except ValueError:
        last = ""
    last = regex.sub(r"\.html?$", "", last)
    out |= {name_key(last), name_key(regex.sub(r"-\d+$", "", last))}
    return {x for x in out if len(x) > 1 and not x.isdigit()}


def containers(url: str | None, body: str, memory: dict | None = None) -> list[tuple[str, str, float, bool, bool, list[int], list[str]]]:
    """(path, path without classes, score, named, headed, lines that would be its main body, their texts) of every container with lines."""
    memory = {} if memory is None else memory
    title = _TITLE.search(body)
    names = page_names(url, visible(title[1]) if title else None)
    longest = 3 * max(map(len, names), default=0) + 20
    tree = [("", "", None)]
    own: list[list[tuple[int, str, str]]] = [[]]
    stack = [(0, "")]
    leaf: set[int] = set()
    hidden = ""  # the element or comment that hides what follows
    for no, line in ((no, part) for no, whole in enumerate(body.split("\n"), 1) for part in elements(whole)):
        at, shown, here = 0, [], stack[-1][0]
        opened = closed = 0
        while at < len(line):
            if hidden:
                end = _ENDS[hidden].search(line, at)
                if not end:
                    at = len(line)
                    break
                at, hidden = end.end(), ""
                continue
            m = _TAG.search(line, at)
            if not m:
                shown.append(line[at:])
                break
            shown.append(line[at : m.start()])
            at = m.end()
            name = (m[2] or "").lower()
            if m[0] == "<!--":
                hidden = "!"
            elif m[0].startswith("<!--"):
                if stack[-1][1] == "hr":
                    stack.pop()
                    closed += 1
            elif name in _ENDS and not m[1]:
                if not (m[3] or "").rstrip().endswith("/"):
                    hidden = name
            elif name == "hr" or name in BLOCKS:
                if m[1]:
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][1] == name:
                            del stack[i:]
                            closed += 1
                            break
                elif name == "body":
                    pass
                else:
                    c = _CLASS.search(m[3] or "")
                    step = name + "".join("." + x for x in sorted((c[1] if c else "").split()))
                    up = tree[stack[-1][0]]
                    stack.append((len(tree), name))
                    tree.append((up[0] + ">" + step, up[1] + ">" + name, stack[-2][0]))
                    own.append([])
                    opened += 1
            else:
                shown.append(m[0])
        text = "".join(shown)
        if text in memory:
            text = memory[text]
        else:
            if len(memory) > MEMORY_LINES:
                memory.clear()
            text = memory[text] = visible(text)
        if text:
            if opened > closed:  # the block begins with text: a paragraph over several lines
                leaf.add(stack[-1][0])
            where = stack[-1][0] if opened > closed else here
            while where in leaf:
                where = tree[where][2]
            own[where].append((no, line, text))
    out = []
    for (path, plain, _), ls in zip(tree, own):
        if not ls:
            continue
        score, named, headed, keep, texts = 0.0, False, False, [], []
        for no, line, text in ls:
            key = name_key(text) if len(text) <= longest else ""
            link = "<a" in line and not _WORD.search(visible(_ANCHOR.sub("", line)))
            if key and key in names and not named:
                named = True
                keep.append(no)
                score += NAME_WORTH
            elif _CONTROL.search(line) or (text[0] == "[" and text[-1] == "]" and not link):
                score -= CONTROL_COST
            elif link:
                score -= LINK_COST
            elif _CRUMB.match(text) and any(name_key(text).endswith(x) for x in names):
                score -= LINK_COST
            else:
                keep.append(no)
                texts.append(text)
                score += min(len(text), 400) * (1.0 if _PROSE.search(text) else 0.4)
                if not headed and _HEADING.search(line):
                    headed = True
                    score += HEADING_WORTH
        out.append((path or ">", plain or ">", score, named, headed, list(dict.fromkeys(keep)), texts))
    return out


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(name_key(text).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def page_containers(pages: DataFrame) -> DataFrame:
    """page_id, host, path, plain, score, named, headed, error, lines, said: the containers of all pages.

    error: 2 for the status of an error, 1 where a page without its own name as a heading says that something is missing or has
    failed. said are digests of the texts, kept for pages of error statuses and those without their own name.
    """
    ok = F.coalesce(F.col("status").between(200, 299), F.lit(True)).alias("ok")
    base = pages.select("page_id", "url", ok, F.coalesce("html", "primary_html").alias("body")).filter("length(trim(body)) > 0")

    def run(batches):
        memory: dict = {}
        for pdf in batches:
            rows = []
            for page, url, ok, body in zip(pdf["page_id"], pdf["url"], pdf["ok"], pdf["body"]):
                try:
                    host = (urlsplit(url or "").hostname or "").removeprefix("www.")
                except ValueError:
                    host = ""
                found = containers(url, body, memory)
                named = any(c[3] for c in found)
                error = 2 if not ok else int(not named and any(len(t) <= 160 and _ERROR.search(t) for c in found for t in c[6]))
                for path, plain, score, own, headed, lines, texts in found:
                    rows.append((page, host, path, plain, score, own, headed, error, lines, [_digest(t) for t in texts] if not named or not ok else []))
            yield pd.DataFrame(rows, columns=["page_id", "host", "path", "plain", "score", "named", "headed", "error", "lines", "said"])

    return base.mapInPandas(run, "page_id bigint, host string, path string, plain string, score double, named boolean, headed boolean, error int, lines array<int>, said array<bigint>")


def host_paths(found: DataFrame) -> DataFrame:
    """host, winner, specific: the path with the most votes on each host.

    The best container of a page has its one vote in each of the two ballots; a container with the page's own name is better than
    any without, one with a main heading better than the rest. Pages of errors have no vote.
    """
    best = found.filter("error = 0 and score > 0").groupBy("page_id").agg(F.max(F.struct("named", "headed", "score", "host", "path", "plain")).alias("b")).select("b.*")
    ballot = best.groupBy("host", "path", "plain").agg(F.count("*").alias("votes"), F.sum("score").alias("weight"))
    # of equal votes the heavier path is the better one
    ballot = ballot.groupBy("host", "plain").agg(F.sum("votes").alias("plain_votes"), F.sum("weight").alias("plain_weight"), F.max(F.struct("votes", "weight", "path")).alias("p"))
    first = ballot.groupBy("host").agg(F.max(F.struct("plain_votes", "plain_weight", "plain", "p")).alias("w")).select("host", "w.*")
    specific = F.col("p.votes") >= SPECIFIC_SHARE * F.col("plain_votes")
    return first.select("host", F.when(specific, F.col("p.path")).otherwise(F.col("plain")).alias("winner"), specific.alias("specific"))


def error_texts(found: DataFrame) -> DataFrame:
    """text: digests of lines that stand on pages of error statuses of at least ERROR_HOSTS hosts."""
    said = found.filter("error = 2").select("host", F.explode("said").alias("text")).distinct()
    return said.groupBy("text").agg(F.count("*").alias("hosts")).filter(F.col("hosts") >= ERROR_HOSTS).select("text")


def main_lines(pages: DataFrame) -> DataFrame:
    """page_id, line_no of the main body's lines, counted from 1 in coalesce(html, primary_html) split at line feeds.

    On each page the best container on its host's winning path is taken, or the best of all where the page has none on it; where
    one carries the page's own name (by its URL or title) as a heading, only such are asked. A page of an error status has no
    main body, nor has one without its own name that speaks of a missing page or a failure, or whose lines are mostly those of
    other hosts' error pages. Null, empty and blank pages have none. Columns besides page_id, url, status, html and primary_html
    aren't read. Repeated page_ids are taken as one page with several readings; the best container wins.
    """
    found = checkpoint(page_containers(pages))
    winners = broadcast_if_small(checkpoint(host_paths(found)))
    won = found.filter("error = 0 and score > 0").join(winners, "host", "left")
    won = won.withColumn("on_path", F.coalesce(F.when(F.col("specific"), F.col("path") == F.col("winner")).otherwise(F.col("plain") == F.col("winner")), F.lit(False)))
    won = won.filter(F.col("named") | F.col("headed") | (F.col("on_path") & F.col("specific")) | (F.col("score") >= PROSE_WORTH))
    pick = won.groupBy("page_id").agg(F.max(F.struct("named", "on_path", "headed", "score", "lines", "said")).alias("b")).select("page_id", "b.*")
    doubtful = pick.filter("not named").select("page_id", F.explode("said").alias("text"))
    known = error_texts(found).withColumn("known", F.lit(1.0))
    failed = doubtful.join(known, "text", "left").groupBy("page_id").agg(F.avg(F.coalesce("known", F.lit(0.0))).alias("share")).filter(F.col("share") >= ERROR_SHARE).select("page_id")
    return pick.join(failed, "page_id", "left_anti").select("page_id", F.explode("lines").alias("n")).select("page_id", F.col("n").cast("bigint").alias("line_no"))
