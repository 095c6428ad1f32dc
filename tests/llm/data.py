"""Small tables with the awkward cases, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, _doc string, n_removed string"


def rows(seed: int = 5, count: int = 60) -> list[tuple]:
    """Documents with copies, near copies, shared passages, NULLs, ties, repeats and extra columns whose names clash."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(2, 7))) for _ in range(300)] + ["Été", "über", "niño", "日本", "a'b"]
    prose = lambda n: " ".join(r.choice(vocabulary) + r.choice(["", "", ",", ".\n"]) for _ in range(n))
    passage, base = prose(70), prose(200)
    texts: list[str | None] = [prose(r.randrange(5, 260)) for _ in range(count)]
    for k in range(0, count, 7):
        texts[k] = prose(40) + " " + passage + " " + prose(30)
    for k in range(3, count, 11):
        words = base.split(" ")
        for _ in range(r.randrange(0, 6)):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        texts[k] = " ".join(words)
    texts[20], texts[21], texts[22], texts[23], texts[24] = texts[9], None, "", " \t\n ", "one two three"
    texts[25], texts[26], texts[27] = "ONE two three", "x " * 130, passage + "\n" + passage
    texts[28] = "y" * 250 + prose(20) + "y" * 180
    texts[29] = passage.replace(" ", "\n\t")
    out = [(k, t, r.choice(["en", "de", None]), r.choice(["s1", "s2", None]), len(t or ""), "s", "d", "n") for k, t in enumerate(texts)]
    out.append(out[9])  # the same row twice
    out.append((None, texts[9], "en", "s1", 1, "s", "d", "n"))
    out.append((None, None, None, None, None, None, None, None))
    r.shuffle(out)
    return out


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def repeated_words(docs: list[tuple], width: int) -> dict:
    """For each (id, text): kept words, by windows that also start in a document with a smaller id."""
    first: dict = {}
    for key, text, *_ in docs:
        w = words(text)
        for i in range(len(w) - width + 1):
            if key is not None:
                s = tuple(w[i : i + width])
                first[s] = min(first.get(s, key), key)
    out = {}
    for key, text, *_ in docs:
        w, gone = words(text), set()
        for i in range(len(w) - width + 1):
            if key is not None and first[tuple(w[i : i + width])] < key:
                gone.update(range(i, i + width))
        out[key, text] = [x for i, x in enumerate(w) if i not in gone]
    return out


def repeated_bytes(docs: list[tuple], width: int) -> dict:
    """For each (id, text): kept bytes and number of removed runs."""
    first: dict = {}
    for key, text, *_ in docs:
        b = (text or "").encode()
        for i in range(len(b) - width + 1):
            if key is not None:
                first[b[i : i + width]] = min(first.get(b[i : i + width], (key, i)), (key, i))
    out = {}
    for key, text, *_ in docs:
        b, gone = (text or "").encode(), set()
        for i in range(len(b) - width + 1):
            if key is not None and first[b[i : i + width]] < (key, i):
                gone.update(range(i, i + width))
        out[key, text] = (bytes(x for i, x in enumerate(b) if i not in gone), sum(i in gone and i - 1 not in gone for i in range(len(b))))
    return out


def reach(nodes: list, links: list[tuple]) -> dict:
    label = {n: n for n in nodes}
    while True:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


def shingles(text: str | None, n: int) -> set:
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def rule_counts(text: str | None) -> tuple[int, int, int, int, int]:
    text, seen, dup = text or "", set(), 0
    w = words(text)
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    times, covered = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)), set()
    for i in range(len(w) - 4):
        if times[tuple(w[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)
