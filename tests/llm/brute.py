"""What the queries must return, computed plainly in Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Sets:
    """Union-find that keeps the smallest member."""

    def __init__(self, members):
        self.up = {m: m for m in members}

    def root(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text, size=5):
    words = WORD.findall(lower(text or ""))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def near_documents(rows, percent=75):
    """{doc_id: (n_shingles, component_id)} for unique ids; every pair that shares a shingle is compared."""
    sets = {i: shingles(t) for i, t in rows}
    groups, holders = Sets(sets), defaultdict(list)
    for i, own in sets.items():
        shared = Counter()
        for x in own:
            shared.update(holders[x])
            holders[x].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                groups.join(i, j)
    return {i: (len(own), groups.root(i)) for i, own in sets.items()}


def near_vectors(rows, cosine=0.98):
    """{vec_id: (n_links, component_id)} for unique ids."""
    def usable(v, label):
        return label is not None and v is not None and None not in v and all(map(math.isfinite, v)) and any(v)

    units = {i: (label, [x / math.sqrt(sum(y * y for y in v)) for x in v]) for i, v, label in rows if usable(v, label)}
    groups, links = Sets([r[0] for r in rows]), Counter()
    ids = sorted(units)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            (a, x), (b, y) = units[i], units[j]
            if a == b and len(x) == len(y) and sum(p * q for p, q in zip(x, y)) >= cosine:
                links.update((i, j))
                groups.join(i, j)
    return {i: (links[i], groups.root(i)) for i, *_ in rows}


def url_parts(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    return (lower(m[1]), m[2]) if m else ("", "")


def base_figures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def line_ends(words, sizes):
    """The first and last words that tell an edited line."""
    return {(side, n, part) for n in sizes for side, part in (("head", words[:n]), ("tail", words[-n:]))}


def common_lines(rows, least=20):
    """{host: lines} that enough documents hold, copies of one text and edited ones counted as one."""
    texts = defaultdict(dict)
    for _, text, host in rows:
        texts[host][text] = [tuple(w.lower() for w in WORD.findall(x)) for x in (text or "").split("\n") if WORD.search(x)]
    common = {}
    for host, own in texts.items():
        times = Counter(x for lines in own.values() for x in set(lines))
        shared = {x for x, n in times.items() if n >= least}
        ends = {e for x in shared for e in line_ends(x, (3, 8))}
        holders = defaultdict(set)
        for text, lines in own.items():
            rest = [x for x in lines if x not in shared]
            alike = sum(len(x) for x in rest if ends & line_ends(x, (8 if len(x) >= 16 else 3,)))
            hashes = sorted({int(hashlib.md5(" ".join(x).encode()).hexdigest()[:15], 16) for x in lines if x in shared})
            if not rest:
                copy = tuple(hashes[:3])
            elif 2 * alike >= sum(map(len, rest)):
                copy = "edited"
            else:
                copy = ("text", text)
            for x in set(lines) & shared:
                holders[x].add(copy)
        common[host] = {x for x, found in holders.items() if len(found) >= least}
    return common


def quality(rows, least=20, depleted=0.7):
    """{doc_id: (*figures, base_failed, removed_words, kept)} of (doc_id, text, host)."""
    common = common_lines(rows, least)
    out = {}
    for i, text, host in rows:
        figures = base_figures(text)
        lines = [tuple(w.lower() for w in WORD.findall(x)) for x in (text or "").split("\n")]
        removed = sum(len(x) for x in lines if x in common[host])
        failed = figures[0] < 20 or 100 * figures[4] > 30 * figures[0]
        out[i] = (*figures, failed, removed, not failed and removed <= depleted * figures[0])
    return out


def mix_targets(sizes, weights=(1, 2, 3), most=3):
    """{source: target} by giving away what is above the limits until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] >= most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= over


def pieces(text, tokenizer, capacity=2048, end=0):
    """(start, length, crc32 of the ids) of every piece of a document."""
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end]
    parts = [ids[i:i + capacity] for i in range(0, len(ids), capacity)]
    return [(i * capacity, len(p), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in p))) for i, p in enumerate(parts)]


def best_fit(lengths, capacity):
    """Number of bins that best-fit decreasing opens."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


def chats(rows):
    """{conv_id: (n_turns, turns_sha256, loss_chars, loss_sha256)} of (conv_id, turn, role, text)."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def page_records(rows, least=1000):
    """Sorted (page_id, payload_bytes, payload_digest, record_type, refers_to) of (page_id, html)."""
    payloads = [(i, (h or "").encode()) for i, h in rows]
    newest = {}
    for i, p in payloads:
        if len(p) >= least and i is not None:
            newest[p] = max(newest.get(p, i), i)
    out = []
    for i, p in payloads:
        first = newest.get(p)
        revisit = first is not None and first != i
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r))


def whitened(vectors, most=32):
    """(kept rows, n, deviations, whitened (rows x components), explained) of lists of floats, by numpy's eigenvectors."""
    import numpy as np

    kept = [i for i, v in enumerate(vectors) if v is not None and None not in v and all(map(math.isfinite, v))]
    x = [[math.floor(64 * c) + 1_000_000 for c in vectors[i]] for i in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    values, found = np.linalg.eigh(centred.T @ centred / n)
    values, found = values[::-1][:most], found[:, ::-1][:, :most]
    return kept, n, deviation, centred @ found / np.sqrt(values), values / (centred ** 2).sum() * n


def edits(a, b):
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelt_words(rows, every=199, least_length=6, least_count=5):
    """{word: n} of (doc_id, text)."""
    import zlib

    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % every == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def word_variants(counts, ratio=5):
    """{word: (form, root, n, n_near, form_n)}, every word compared with every other."""
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and edits(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] is not None else None)
    return out


def benchmark_hits(rows, items, longest=10):
    """[(doc_id, n_words, n_hit, sorted ids)] of (doc_id, text) and (item_id, text)."""
    split = lambda t: re.findall("[0-9a-z\u0080-\U0010ffff]+", lower(t or ""))
    windows = defaultdict(set)
    for i, text in items:
        words = split(text)
        g = min(longest, len(words))
        for s in range(len(words) - g + 1 if g else 0):
            windows[tuple(words[s:s + g])].add(i)
    lengths, out = {len(w) for w in windows}, []
    for i, text in rows:
        words, hit, ids = split(text), set(), set()
        for g in lengths:
            for s in range(len(words) - g + 1):
                found = windows.get(tuple(words[s:s + g]))
                if found:
                    hit |= set(range(s, s + g))
                    ids |= found
        out.append((i, len(words), len(hit), sorted(str(x) for x in ids if x is not None)))
    return out
