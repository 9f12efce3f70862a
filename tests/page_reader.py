"""Brute-force reading of a page with the standard library, for comparison in tests."""

from __future__ import annotations

from html.parser import HTMLParser


class PageReader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = [""]
        self.silent: list[str] = []
        self.links: list[str] = []
        self.alts: list[str] = []
        self.metas: list[dict] = []

    def handle_starttag(self, tag, attrs):
        self.pieces.append("")
        values = {name: value or "" for name, value in attrs}
        if tag in ("script", "style", "template", "rt", "rp"):
            self.silent.append(tag)
        if tag == "a" and "href" in values:
            self.links.append(values["href"])
        if tag == "img" and values.get("alt"):
            self.alts.append(values["alt"])
        if tag == "meta":
            self.metas.append(values)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.pieces.append("")
        if tag in self.silent:
            self.silent.remove(tag)

    def handle_comment(self, data):
        self.pieces.append("")

    def handle_data(self, data):
        if not self.silent:
            self.pieces[-1] += data


def read(html: str) -> PageReader:
    reader = PageReader()
    reader.feed(html)
    reader.close()
    return reader


def content(html: str) -> str:
    page = read(html)
    text = " ".join(p.strip() for p in page.pieces if p.strip())
    parts = [text, " ".join(page.alts)]
    for key, wanted in (("name", "description"), ("property", "og:description")):
        found = [m["content"] for m in page.metas if m.get(key) == wanted and "content" in m]
        if found:
            parts.append(found[0])
            break
    return " ".join(parts).replace("\n", " ").replace("\r", " ")
