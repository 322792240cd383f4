"""Plain versions of the contracts, one document at a time."""

import base64
import hashlib
import re

import numpy as np
import xxhash


def words_alnum(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def words_white(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def licenses(text):
    ws = words_alnum(text)
    places = []
    for label, phrase in (("cc-by", "cc by"), ("gpl", "general public license"),
                          ("reserved", "all rights reserved")):
        p = phrase.split()
        places += [(i, label) for i in range(len(ws)) if ws[i:i + len(p)] == p]
    starts = [i for i, _ in places]
    return (len(ws), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({k for _, k in places})))


SECRETS = {
    "assign": re.compile(r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]"
                         r"|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
                         r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
    "access": re.compile("(AKIA[A-Z0-9]+)"),
    "hex": re.compile("([0-9a-f]+)"),
}


def secrets(text):
    spans = []
    for k, (kind, rx) in enumerate(SECRETS.items()):
        for m in rx.finditer(text or ""):
            if len(m[1]) >= {"assign": 12, "access": 18, "hex": 16}[kind]:
                spans.append((m.start(), k, kind, m.end()))
    spans.sort()
    count = [sum(s[2] == k for s in spans) for k in SECRETS]
    return (*count, sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)))


def fingerprint(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    ws = words_white(t)
    if not ws:
        return 0
    sh = [" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows):
    """{id: (fingerprint, least id reachable)} of (id, text) rows."""
    fp = {i: fingerprint(t) for i, t in rows}
    ids = sorted(fp)
    arr = np.array([fp[i] for i in ids], np.uint64)
    seen = {}
    for k, i in enumerate(ids):
        if i in seen:
            continue
        todo = [k]
        seen[i] = i
        while todo:
            x = todo.pop()
            near = np.flatnonzero(np.bitwise_count(arr ^ arr[x]) <= 2)
            for j in near.tolist():
                if ids[j] not in seen:
                    seen[ids[j]] = i
                    todo.append(j)
    return {i: (fp[i], seen[i]) for i in ids}


def decontaminate(text, items):
    ws = words_alnum(text)
    hit, found = set(), set()
    for item, t in items:
        iw = words_alnum(t)
        n = min(13, len(iw))
        if not n:
            continue
        wins = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)}
        for i in range(len(ws) - n + 1):
            if tuple(ws[i:i + n]) in wins:
                found.add(str(item))
                hit.update(range(i, i + n))
    n = len(hit)
    return len(ws), n, len(found), sha(",".join(sorted(found))), n > 0 and 20 * n >= len(ws)


def repeats(texts, n=200):
    """Per text: (bytes, removed, spans, digest of what is left)."""
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for d, b in enumerate(raw):
        for i in range(len(b) - n + 1):
            seen.setdefault(b[i:i + n], []).append((d, i))
    marks = [np.zeros(len(b) + 1, np.int64) for b in raw]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                marks[d][i] += 1
                marks[d][i + n] -= 1
    out = []
    for b, m in zip(raw, marks, strict=True):
        gone = np.cumsum(m)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((len(b), int(gone.sum()), spans, sha(left)))
    return out


def quality(text):
    ws = words_white(text)
    lines = [x for x in (text or "").split("\n") if words_white(x)]
    wins = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    many = {w for w in wins if wins.count(w) > 1} if len(wins) < 3000 else \
        {w for w, c in __import__("collections").Counter(wins).items() if c > 1}
    cover = {i + k for i, w in enumerate(wins) if w in many for k in range(3)}
    n, r = len(ws), len(cover)
    return (n, sum(map(len, ws)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), r, n < 50 or 100 * r > 50 * n)


def pages(rows):
    """{id: (bytes, digest, type, refers_to)} of (id, html) rows."""
    last = {}
    for i, h in rows:
        last[h or ""] = max(i, last.get(h or "", i))
    out = {}
    for i, h in rows:
        b = (h or "").encode()
        k = last[h or ""]
        out[i] = (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                  "response" if i == k else "revisit", None if i == k else k)
    return out


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"),
         ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def url(u):
    if not u or "://" not in u:
        return "", "", None, "allow"
    rest = u.split("://", 1)[1]
    raw = re.match(r"[^/?#]*", rest)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
    path = re.match(r"[^?#]*", rest[len(raw):])[0]
    fit = [(len(h + p), h + p, v) for v, h, p in RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[1], best[2] if best else "allow"
