"""Last-resort reader of malformed parameter text.

One pass over one text with a cursor and a stack of open objects; nothing is
sliced or read twice, whatever the nesting. Behaviour to match:

* outer white space and any run of ``{``/``}`` at both ends are dropped;
* the text is read as ``"key": value`` pairs; what does not start a key is
  skipped;
* a value is, by its first character: a string up to the next unescaped quote
  (or to the end when unclosed); an integer or decimal number; a nested object
  up to its matching brace, read the same way (to the end when unclosed); a list
  up to its matching bracket (JSON if it parses, else its text; an empty list
  when unclosed); ``true``, ``false``, ``null``; else the text up to the next
  ``,`` ``}`` or ``]``, or to the end if that comes first.

A text whose reading fails (a number beyond Python's digit limit, nesting that
cannot be written as JSON) gives null, which ends at the sentinel.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa

# The patterns of a key and of a number.
KEY = re.compile(r'\s*"([^"]+)"\s*:\s*')
NUMBER = re.compile(r"-?\d+(?:\.\d+)?")
QUOTE = re.compile(r'(?<!\\)"')
STOP = re.compile(r"[,}\]]")
#: Nesting that JSON readers on the JVM accept, less the result object around the params.
MAX_DEPTH = 998
CONSTANTS = {"t": ("true", True), "f": ("false", False), "n": ("null", None)}


def _partners(text: str) -> dict[int, int]:
    """Position of every closed ``{`` or ``[`` -> position after what closes it; each kind on its own."""
    opened: dict[str, list[int]] = {"}": [], "]": []}
    ends = {}
    for m in re.finditer(r"[{}\[\]]", text):
        at, c = m.start(), m[0]
        if c in "{[":
            opened["}" if c == "{" else "]"].append(at)
        elif opened[c]:
            ends[opened[c].pop()] = at + 1
    return ends


def _bare(text: str, lo: int, hi: int) -> tuple[int, int]:
    """The range without outer white space, braces and the white space inside those."""
    for drop in (str.isspace, "{}".__contains__, str.isspace):
        while lo < hi and drop(text[lo]):
            lo += 1
        while lo < hi and drop(text[hi - 1]):
            hi -= 1
    return lo, hi


class _Reader:
    """Cursor ``at`` in ``text``; ``end`` is where the innermost open object ends."""

    def __init__(self, text: str):
        self.text, self.ends = text, _partners(text)
        self.at, self.end = _bare(text, 0, len(text))

    def string(self):
        m = QUOTE.search(self.text, self.at + 1, self.end)
        start, self.at = self.at + 1, m.end() if m else self.end
        return self.text[start : m.start() if m else self.end]

    def listed(self):
        start, close = self.at, self.ends.get(self.at, self.end + 1)
        if close > self.end:
            self.at = self.end
            return []
        self.at = close
        try:
            return json.loads(self.text[start:close])
        except ValueError:
            return self.text[start:close]

    def plain(self):
        number = NUMBER.match(self.text, self.at, self.end)
        if number:
            self.at = number.end()
            return float(number[0]) if "." in number[0] else int(number[0])
        word, constant = CONSTANTS.get(self.text[self.at], ("", None))
        if word and self.text.startswith(word, self.at, self.end):
            self.at += len(word)
            return constant
        stop = STOP.search(self.text, self.at, self.end)
        start, self.at = self.at, stop.start() if stop and stop.start() > self.at else self.end
        return self.text[start : self.at].strip()

    def pairs(self) -> dict:
        root: dict = {}
        into, outer = root, []  # outer: (object, its end, where it goes on) around the one being filled
        while True:
            key = KEY.search(self.text, self.at, self.end)
            if key is None:
                if not outer:
                    return root
                into, self.end, self.at = outer.pop()
                continue
            self.at = key.end()
            head = self.text[self.at] if self.at < self.end else ""
            if head == "{":
                if len(outer) >= MAX_DEPTH:
                    raise ValueError("nested too deep to be written as JSON")
                close = min(self.ends.get(self.at, self.end + 1), self.end + 1)
                outer.append((into, self.end, min(close, self.end)))
                into[key[1]] = into = {}
                self.at, self.end = _bare(self.text, self.at + 1, close - 1)
            else:
                into[key[1]] = self.string() if head == '"' else self.listed() if head == "[" else self.plain() if head else ""


def read_pairs(text: str) -> dict:
    """The pairs of ``text`` as a dict; later keys win."""
    return _Reader(text).pairs()


def scan_to_json(text: str | None) -> str | None:
    """Compact JSON of :func:`read_pairs`, key order and UTF-8 kept; null if it cannot be read."""
    if text is None:
        return None
    try:
        return json.dumps(read_pairs(text), ensure_ascii=False, separators=(",", ":"))
    except (ValueError, RecursionError):
        return None


def scan_texts(texts: pa.Array) -> pa.Array:
    """:func:`scan_to_json` of every text; null stays null."""
    return pa.array([scan_to_json(t) for t in texts.to_pylist()], pa.string())
