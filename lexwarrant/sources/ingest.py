"""Fetching collections to files: one item at a time, each written whole or not at all.

Every function takes the fetchers it uses. What is held or was rejected before isn't fetched again.
"""

from __future__ import annotations

import json
import os
import time
import urllib.request
from collections.abc import Callable, Iterable
from pathlib import Path
from urllib.parse import quote

from ..functions.registry import FIXED
from ..functions.urls import AGENT

Get = Callable[[str], str | None]
TEXT_FORMAT = "DjVuTXT"
SHORTEST_SCAN, SHORTEST_BOOK = 20_000, 2_000


def http_get(url: str, timeout: float = 30.0) -> str | None:
    """A page's text; None on any failure."""
    try:
        request = urllib.request.Request(url, headers={"User-Agent": AGENT, "Accept": "text/html,application/xhtml+xml,text/xml"})
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace")
    except (OSError, ValueError, LookupError):
        return None


def http_size(url: str, timeout: float = 30.0) -> int | None:
    """The size a server gives without sending the body; None if it gives none."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, method="HEAD", headers={"User-Agent": AGENT}), timeout=timeout) as answer:
            length = answer.headers.get("Content-Length")
            return int(length) if length is not None else None
    except (OSError, ValueError):
        return None


def write_whole(path: str | Path, text: str) -> None:
    """A reader of the folder sees no file or all of it; a folder that went away is made again."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(path.name + ".part")
    part.write_text(text, "utf-8")
    os.replace(part, path)


def _first_columns(path: Path) -> set[str]:
    return {line.split("\t")[0] for line in path.read_text("utf-8").split("\n") if line} if path.exists() else set()


def held(folder: str | Path) -> set[str]:
    """Items with a text in the folder, and those rejected before."""
    folder = Path(folder)
    return {p.stem for p in folder.glob("*.txt")} | _first_columns(folder / "rejected.tsv")


def search_address(query: str, rows: int) -> str:
    """A search of the scan archive: a bare name is a collection; items with text, most downloaded first."""
    query = query if ":" in query else f"collection:{query}"
    return f"https://archive.org/advancedsearch.php?q={quote(f'{query} AND format:{chr(34)}{TEXT_FORMAT}{chr(34)}')}&fl%5B%5D=identifier&sort%5B%5D=downloads+desc&rows={rows}&output=json"


def text_name(item: str, get: Get) -> str | None:
    """The name of an item's text file, which its metadata has."""
    try:
        files = json.loads(get(f"https://archive.org/metadata/{item}") or "{}").get("files") or []
    except ValueError:
        return None
    return next((f["name"] for f in files if f.get("format") == TEXT_FORMAT), None)


def fetch_archive(folder: str | Path, query: str, wanted: int, get: Get, delay: float = 0.2) -> int:
    """Fetch up to ``wanted`` scanned books not held yet; ``files.tsv`` records each text's name."""
    answer = get(search_address(query, 2 * wanted))
    if answer is None:
        raise ConnectionError("the search gave no answer")
    folder, saved, known = Path(folder), 0, held(folder)
    for item in (d["identifier"] for d in json.loads(answer)["response"]["docs"]):
        if saved >= wanted:
            break
        if item in known:
            continue
        name = text_name(item, get)
        time.sleep(delay)
        text = get(f"https://archive.org/download/{item}/{quote(name, safe='')}") if name else None
        time.sleep(delay if name else 0)
        if text is None or len(text) < SHORTEST_SCAN:
            continue
        write_whole(folder / f"{item}.txt", text)
        with (folder / "files.tsv").open("a", encoding="utf-8") as manifest:
            manifest.write(f"{item}\t{name}\n")
        saved += 1
    return saved


def backfill_names(folder: str | Path, get: Get, delay: float = 0.12) -> int:
    """Record the text names of books fetched before names were recorded."""
    folder, found = Path(folder), 0
    missing = {p.stem for p in folder.glob("*.txt")} - _first_columns(folder / "files.tsv")
    for item in sorted(missing):
        name = text_name(item, get)
        if name:
            with (folder / "files.tsv").open("a", encoding="utf-8") as manifest:
                manifest.write(f"{item}\t{name}\n")
            found += 1
        time.sleep(delay)
    return found


def fetch_books(folder: str | Path, ids: Iterable[str], get: Get, wanted: int, delay: float = 0.2) -> int:
    """Fetch catalogue books by id, as plain text, unless held."""
    folder, saved, known = Path(folder), 0, held(folder)
    for book in ids:
        if saved >= wanted:
            break
        if f"pg{book}" in known:
            continue
        text = get(FIXED["gut"].template.replace("{id}", book))
        time.sleep(delay)
        if text is not None and len(text) >= SHORTEST_BOOK:
            write_whole(folder / f"pg{book}.txt", text)
            saved += 1
    return saved


class Unreachable(ConnectionError):
    """A status that could not be read, which is not the same as one that isn't there."""


def remote_status(tag: str, fetch: Callable[[str], tuple[int, str]], address: str) -> dict:
    """One language's published status; 404 is an unmeasured language, anything else but 200 is an error."""
    code, body = fetch(address.replace("{tag}", tag))
    if code == 404:
        return {"language": tag, "published": True, "built": False, "steps": []}
    if code != 200:
        raise Unreachable(f"{tag}: the server answered {code}")
    found = json.loads(body)
    ships = {True: "yes", False: "held"}.get(found.get("ships"), found.get("ships"))
    return found | {"language": tag, "published": True, "built": True, "ships": ships if ships in ("yes", "held") else "pending"}


def published_languages(fetch: Callable[[str], tuple[int, str]], address: str, prefix: str) -> list[str]:
    """Tags of the languages an organisation has published: names of its repositories that begin with
    ``prefix``. ``address`` takes a page number; pages are asked for until one is empty."""
    tags, page = [], 1
    while True:
        code, body = fetch(address.replace("{page}", str(page)))
        if code != 200:
            raise Unreachable(f"the listing answered {code}")
        rows = json.loads(body)
        if not rows:
            return sorted(tags)
        tags += [r["name"][len(prefix) :] for r in rows if r["name"].startswith(prefix) and not r.get("archived")]
        page += 1


def published_statuses(fetch: Callable[[str], tuple[int, str]], listing: str, address: str, prefix: str) -> list[dict]:
    """The published status of every language the organisation lists."""
    return [remote_status(tag, fetch, address) for tag in published_languages(fetch, listing, prefix)]
