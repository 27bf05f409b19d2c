"""Plain versions of the contracts, one document at a time, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def decontaminated(docs, items, gram=10):
    patterns = defaultdict(set)
    for item, text in items:
        words = item_words(text)
        if words:
            for i in range(max(1, len(words) - gram + 1)):
                patterns[tuple(words[i : i + gram])].add(item)
    out = []
    for doc, text in docs:
        words, hit, found = item_words(text), set(), set()
        for n in {len(p) for p in patterns}:
            for i in range(len(words) - n + 1):
                owners = patterns.get(tuple(words[i : i + n]))
                if owners:
                    hit.update(range(i, i + n))
                    found |= owners
        found = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(words), len(hit), len(found), sha(",".join(found)), bool(hit)))
    return out


def base_secrets(text):
    text, found = text or "", []
    for m in re.finditer(
        r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|"""
        r"""(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        text,
    ):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 18:
            found.append((m.start(), 1, "access", m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 16:
            found.append((m.start(), 2, "hex", m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def shingle_set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return set()
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def near_duplicates(docs, n=3, num=85, den=100):
    """(doc, set size, smallest id reachable, kept) for distinct ids."""
    sets = {doc: shingle_set(text, n) for doc, text in docs}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders = defaultdict(list)
    for d in sorted(sets):
        counts = Counter(o for s in sets[d] for o in holders[s])
        for o, common in counts.items():
            if den * common >= num * (len(sets[d]) + len(sets[o]) - common):
                a, b = sorted((root(d), root(o)))
                parent[b] = a
        for s in sets[d]:
            holders[s].append(d)
    return [(d, len(sets[d]), root(d), root(d) == d) for d in sets]


def url_base(url):
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
    host = lower(host)
    best = None
    for rule in rules:
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            best = max(best or "", rule, key=len)
    return host, path, best, rules.get(best)


def text_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines, again, seen = text.split("\n"), 0, set()
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, again, len(covered), failed


def without_lines(docs, long_line=25):
    """(doc, lines, lines removed, text) of distinct ids."""
    blanks, first, runs_of = " \t\n\x0b\x0c\r", {}, {}
    for doc, text in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        lines = [(i, x.strip(blanks)) for i, x in enumerate((text or "").split("\n"))]
        lines = [x for x in lines if x[1]]
        runs = [tuple(lines[i : i + 3]) for i in range(len(lines) - 2)]
        runs += [(x,) for x in lines if len(x[1].split()) >= long_line]
        runs_of[doc] = runs
        for run in sorted(runs, key=lambda r: r[0][0]):
            first.setdefault(tuple(x for _, x in run), (doc, run[0][0]))
    out = []
    for doc, text in docs:
        gone = {i for r in runs_of[doc] if first[tuple(x for _, x in r)] != (doc, r[0][0]) for i, _ in r}
        lines = (text or "").split("\n")
        left = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((doc, 0 if text is None else len(lines), len(gone), left))
    return out


def without_repeats(docs, length):
    """(doc, bytes, removed, runs, hash of the rest) for each row."""
    texts = [(text or "").encode() for _, text in docs]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(docs, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        left = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((doc, len(t), sum(gone), runs, sha(left)))
    return out


def crc_fold(doc, folds):
    return zlib.crc32(str(doc).encode()) % folds
