"""Plain versions of the operators, one text at a time."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def quality(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words, seen, copies, covered = WORD.findall(text), set(), 0, set()
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 5))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(covered), failed


def verdict(text: str, phrases: tuple[str, ...]) -> tuple[str, int, bool]:
    """The clean text, the number of lines removed, and kept."""
    every, seen, clean, lost, removed = text.split("\n"), set(), "", 0, 0
    for k, line in enumerate(every):
        spans = [m.span() for m in WORD.finditer(line)]
        n, chars, said = len(spans), sum(b - a for a, b in spans), set()
        for p in phrases:
            for m in re.finditer(f"(?<![a-z0-9])(?={re.escape(p)}(?![a-z0-9]))", lower(line)):
                said |= {i for i, (a, b) in enumerate(spans) if a < m.start() + len(p) and b > m.start()}
        marks = len(re.findall("[!?]", line))
        fails = n and (
            line in seen
            or 100 * len(re.findall("[|>]", line)) > 25 * n
            or (marks > 1 and 100 * marks > 30 * n)
            or 100 * len(re.findall("[#*$%&<]", line)) > 10 * chars
            or (said and 100 * len(said) >= 30 * n)
        )
        seen |= {line} if n else set()
        lost, removed = (lost + chars, removed + 1) if fails else (lost, removed)
        clean += "" if fails else line + "\n" * (k < len(every) - 1)
    measures = quality(text)
    return clean, removed, not measures[-1] and 100 * lost <= 50 * measures[1]


def shingles(text: str | None, size: int) -> set:
    words = WORD.findall(lower(text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def near(rows: list[tuple], size: int) -> list[tuple]:
    """(key, n, smallest key reachable) of each row, rows linked at a similarity of 0.8."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = defaultdict(list)
    for k, own in enumerate(sets):
        both = Counter(o for s in own for o in having[s])
        for o, n in both.items():
            if 100 * n >= 80 * (len(own) + len(sets[o]) - n):
                parent[top(k)] = top(o)
        for s in own:
            having[s].append(k)
    least: dict = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            least[top(k)] = min(least.get(top(k), key), key)
    return [(key, len(sets[k]), least.get(top(k))) for k, (key, _) in enumerate(rows)]


def repeats(texts: list[str | None], least: int) -> list[tuple]:
    """n_bytes, n_removed, n_spans, sha256 of what is left, of each text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(x[i : i + least] for x in data for i in range(len(x) - least + 1))
    out = []
    for x in data:
        gone = bytearray(len(x))
        for i in range(len(x) - least + 1):
            if count[x[i : i + least]] > 1:
                gone[i : i + least] = b"\1" * least
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def terms(text: str | None) -> list[str]:
    return re.findall("[a-z0-9\u0080-\U0010ffff]+", lower(text or ""))


def leaks(docs: list[tuple], items: list[tuple]) -> set:
    """(key, item) where all of the item's terms stand in a row."""
    known = [(i, f" {' '.join(terms(t))} ") for i, t in items if terms(t)]
    return {(k, i) for k, t in docs for i, own in known if own in f" {' '.join(terms(t))} "}


def bm25(docs: list[tuple], items: list[tuple], step: int, k1: float = 1.2, b: float = 0.75) -> dict:
    """(key, item) -> the best share of the item's own score that a passage of 2 * step words gets,
    for all that share a term; passages start every step words."""
    own = {i: Counter(terms(t)) for i, t in items}
    df = Counter(w for c in own.values() for w in c)
    mean = sum(sum(c.values()) for c in own.values()) / len(items)
    best: dict = defaultdict(float)
    for k, text in docs:
        said = terms(text)
        for lo in range(0, max(len(said) - step, 1), step):
            passage = set(said[lo : lo + 2 * step])
            for i, c in own.items():
                size = sum(c.values())
                weight = {w: math.log(1 + (len(items) - df[w] + 0.5) / (df[w] + 0.5)) * n * (k1 + 1) / (n + k1 * (1 - b + b * size / mean)) for w, n in c.items()}
                score = sum(v for w, v in weight.items() if w in passage) / sum(weight.values())
                if score:
                    best[k, i] = max(best[k, i], score)
    return best
