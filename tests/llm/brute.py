"""Plain single-machine versions that the operators are held against."""

from __future__ import annotations

import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(ids: list, linked) -> dict:
    """id -> least id reachable; `linked(i, j)` on positions."""
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                if ids[a] < ids[b]:
                    a, b = b, a
                parent[a] = b
    return {v: ids[find(k)] for k, v in enumerate(ids)}


def base_features(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen: dict = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {k for i, w in enumerate(windows) if seen[w] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def simhash(text: str | None) -> int:
    import xxhash
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def repeats_removed(docs: list[tuple[int, bytes]], length: int = 50) -> list[tuple[int, bytes, int, int]]:
    """(id, kept, removed bytes, spans) of each document in order of the list."""
    first: dict[bytes, int] = {}
    for i, t in docs:
        for k in range(len(t) - length + 1):
            w = t[k:k + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in docs:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if first[t[k:k + length]] < i:
                gone[k:k + length] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(t) else 0
        out.append((i, bytes(b for b, g in zip(t, gone) if not g), int(gone.sum()), spans))
    return out


def without_template(pages: list[tuple[str, tuple]], support: float = 0.5, min_pages: int = 3) -> list[str]:
    """The main text of each page (host, what `html_extract.parse` finds), by whole occurrence vectors."""
    out = [""] * len(pages)
    for host in {h for h, _ in pages}:
        mine = [i for i, (h, _) in enumerate(pages) if h == host]
        votes: dict[str, tuple] = {}
        for i in mine:
            blocks, counts, sections, _ = pages[i][1]
            shown = {t for t, _ in blocks}
            seen = {t: n for t, n in counts.items() if t not in sections or t in shown}
            votes.setdefault("\0".join(x for _, x in blocks), (seen, sections))
        voters = list(votes.values())
        section = {t: s for seen, sections in voters for t, s in sections.items() if t in seen}
        classes: dict[tuple, set] = {}
        for t in {t for seen, _ in voters for t in seen}:
            classes.setdefault(tuple(seen.get(t, 0) for seen, _ in voters), set()).add(t)
        template = set()
        for vector, tokens in classes.items():
            on = sum(n > 0 for n in vector)
            if on >= min_pages and on >= support * len(voters) and any(t not in section for t in tokens):
                template |= {t for t in tokens if t in section}
        open_sections = {s for t, s in section.items() if t not in template}
        for i in mine:
            blocks, _, _, inside = pages[i][1]
            whole = "\n\n".join(x for _, x in blocks)
            rest = "\n\n".join(x for t, x in blocks if t not in template or section[t] in open_sections)
            out[i] = whole if inside and 2 * len(rest) <= len(whole) else rest
    return out
