"""Plain versions of the operators' contracts, for comparison on small tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def chats(rows):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        said[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, turns in said.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        lost = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(lost), sha(lost))
    return out


def luhn(d):
    s = 0
    for i, c in enumerate(d[::-1]):
        v = int(c) * (2 if i % 2 else 1)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def base_spans(text):
    text = text or ""
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda s: re.sub("[^0-9]", "", s)
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return out


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def phrases(text):
    w = words(text)
    found = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    at = [i for i, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def contamination(texts, items, length=10):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(len(w), length)
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[k]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((len(w), len(hit), len(ids), sha(",".join(ids)), bool(hit)))
    return out


def near_items(texts, items, length=10, rarest=3, slop=20):
    """Items of which some window's rarest words stand in a text so that the beginnings they speak for differ by ``slop`` at most."""
    counts = Counter(w for t in texts for w in words(t))
    needs = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(len(w), length)
        for i in range(len(w) - n + 1 if n else 0):
            if all(counts[w[j]] for j in range(i, i + n)):
                needs[item, tuple(w)].add(tuple(sorted(range(i, i + n), key=lambda j: (counts[w[j]], j))[:rarest]))
    out = []
    for text in texts:
        at = defaultdict(list)
        for p, w in enumerate(words(text)):
            at[w].append(p)
        found = set()
        for (item, w), places in needs.items():
            for need in places:
                firsts = {p - j for j in need for p in at[w[j]]}
                if any(all(any(b <= p - j <= b + slop for p in at[w[j]]) for j in need) for b in firsts):
                    found.add(item)
        out.append(len({str(x) for x in found if x is not None}))
    return out


def payload(html):
    data = (html or "").encode()
    return len(data), base64.b32encode(hashlib.sha1(data).digest()).decode()


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def components(rows):
    """rows: (id, text) with different ids; id -> (set size, component)."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    shared = defaultdict(int)
    for ids in holders.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def pieces(text, tokenizer, longest=2048):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
    return ids, lambda start, length: zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[start : start + length]))


def edited(texts_by_id):
    """id -> edited text, in descending order of ids."""
    order = sorted(texts_by_id, reverse=True)
    out = {}
    for k, i in enumerate(order):
        text, following = texts_by_id[i] or "", texts_by_id[order[(k + 1) % len(order)]] or ""
        n = len(text) // 3
        out[i] = text[: len(text) - n] + following[:n]
    return out
