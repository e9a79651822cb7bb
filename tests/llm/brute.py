"""Plain versions of the operators, straight from their contracts."""

import base64
import collections
import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def removed_sentences(docs, sentences, least_sentences=3, least_words=20):
    """Positions of removed sentences per (id, text); equal rows are one document."""
    order = sorted(set(docs), key=lambda x: (x[0] is None, x[0] if x[0] is not None else 0))
    seen, gone = set(), {}
    for doc in order:
        parts, out = sentences(doc[1] or ""), set()
        for i in range(len(parts)):
            j, n = i, 0
            while j < len(parts) and (j - i < least_sentences or n < least_words):
                n += len(parts[j])
                j += 1
            if j - i >= least_sentences and n >= least_words:
                run = tuple(" ".join(p).lower() for p in parts[i:j])
                if run in seen:
                    out |= set(range(i, j))
                seen.add(run)
        gone[doc] = out
    return gone


def contamination(docs, bench, window=13):
    windows, lengths = collections.defaultdict(set), set()
    for item, text in bench:
        w = LETTERS.findall((text or "").translate(LOW))
        if w:
            m = min(window, len(w))
            lengths.add(m)
            for a in range(len(w) - m + 1):
                windows[tuple(w[a:a + m])].add(item)
    out = []
    for doc, text in docs:
        w, hit, items = LETTERS.findall((text or "").translate(LOW)), set(), set()
        for m in lengths:
            for a in range(len(w) - m + 1):
                found = windows.get(tuple(w[a:a + m]))
                if found:
                    hit.update(range(a, a + m))
                    items |= found
        items.discard(None)
        out.append((doc, len(w), len(hit), len(items), sha(",".join(sorted(map(str, items)))), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def archive(pages):
    best = {}
    for page, html in pages:
        if page is not None:
            body = (html or "").encode()
            best[body] = max(best.get(body, page), page)
    out = []
    for page, html in pages:
        body = (html or "").encode()
        first = best.get(body)
        revisit = first is not None and first != page
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "revisit" if revisit else "response", first if revisit else None))
    return out


def targets(docs, weights=(5, 2, 1)):
    """Size and target per source, by sharing again and again."""
    size = collections.Counter()
    for _, text, source in docs:
        size[source] += len(WORD.findall(text or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    left, free, out = 1.5 * sum(size.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 2 * size[s]}
        if not full:
            return size, out | {s: weight[s] * level for s in free}
        for s in full:
            out[s] = 2.0 * size[s]
            left -= out[s]
        free -= full
    return size, out


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def personal(text):
    text, out = text or "", []
    if "@" in text:
        out += [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(len(x) <= 3 and int(x or 0) <= 255 for x in (p.lstrip("0") for p in m[0].split(".")))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{s}:{e}" for k, s, e in sorted(out))


def groups(docs, size, percent=80):
    """(id, set size, component, kept); rows of one id are one node."""
    sets = []
    for _, text in docs:
        w = WORD.findall((text or "").translate(LOW))
        k = min(size, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set())
    places, parent = collections.defaultdict(list), list(range(len(docs)))
    for i, s in enumerate(sets):
        for x in s:
            places[x].append(i)

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j, n in collections.Counter(j for x in s for j in places[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    ids = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            if doc in ids and sets[i] and sets[ids[doc]]:
                parent[root(i)] = root(ids[doc])
            ids.setdefault(doc, i)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    out = []
    for i, (doc, _) in enumerate(docs):
        c = least.get(root(i)) if sets[i] else doc
        out.append((doc, len(sets[i]), c, c is None or doc == c))
    return out


def secret_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(out)]


def quality(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    triples, repeated = collections.Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if triples[w[i], w[i + 1], w[i + 2]] > 1:
            repeated |= {i, i + 1, i + 2}
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated),
            len(w) < 50 or 100 * len(repeated) > 50 * len(w))


def remainder(doc, parts):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % parts


def unigram(docs):
    """(id, held out, tokens, known, training tokens, base score)."""
    tokens = [[*WORD.findall((text or "").translate(LOW)), None] for _, text in docs]
    held = [remainder(doc, 7) == 2 for doc, _ in docs]
    c = collections.Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(doc, h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for (doc, _), ws, h in zip(docs, tokens, held)]


def planted(doc_id, words):
    """Words with the repeated passage that the contract sets into one text of ten."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def periodic_runs(x):
    """(start, length, period) of every run, one shift after the other."""
    found = {}
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def periodic(docs):
    """Rows of op11."""
    out = []
    for doc_id, text in docs:
        words = planted(doc_id, WORD.findall(text or ""))
        runs = periodic_runs(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        out.append((doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
                    sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))))
    return out


def codebooks(rows, parts=8, entries=16, rounds=6):
    """Rows of op12 from (vec_id, vector, label)."""
    kept = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // parts
    cut = [[v[p * size:(p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = collections.defaultdict(list)
            for c in cut:
                members[nearest(c[p], books[p])[1]].append(c[p])
            for k, own in members.items():
                books[p][k] = [sum(col) // len(own) for col in zip(*own)]
    digest = sha(",".join(str(x) for book in books for e in book for x in e))
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    per_label = collections.Counter()
    for (_, _, lab), e in zip(kept, errors):
        per_label[lab] += e
    return [(i, "".join(f"{k:02x}" for _, k in f), e, per_label[lab], digest) for (i, _, lab), f, e in zip(kept, found, errors)]
