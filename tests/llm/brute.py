"""Plain versions of the operators, row by row, for small inputs."""

import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def substring_dedup(docs, k=50):
    """{doc_id: (n_words, n_removed, kept_sha256)}"""
    words = {d: WORD.findall(t or "") for d, t in docs}
    first = {}
    for d in sorted(words):
        for p in range(len(words[d]) - k + 1):
            first.setdefault(tuple(words[d][p: p + k]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for p in range(len(w) - k + 1):
            if first[tuple(w[p: p + k])] < d:
                gone.update(range(p, p + k))
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def decontaminate(docs, items, k=13):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    windows = {}
    for item, text in items:
        w = TERM.findall((text or "").translate(UPPER))
        for p in range(max(1, len(w) - k + 1) if w else 0):
            windows.setdefault(tuple(w[p: p + k]), set()).add(str(item))
    sizes = sorted({len(x) for x in windows})
    out = {}
    for d, text in docs:
        w = TERM.findall((text or "").translate(UPPER))
        hit, found = set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                got = windows.get(tuple(w[p: p + n]))
                if got:
                    hit.update(range(p, p + n))
                    found |= got
        out[d] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w))
    return out


def near_items(docs, items, slop, k=13):
    """{doc_id: items with a window whose every word lies within slop words of its place}, every place tried"""
    windows = {}
    for item, text in items:
        w = TERM.findall((text or "").translate(UPPER))
        for p in range(max(1, len(w) - k + 1) if w else 0):
            windows.setdefault(tuple(w[p: p + k]), set()).add(str(item))
    out = {}
    for d, text in docs:
        w = TERM.findall((text or "").translate(UPPER))
        places = {}
        for i, x in enumerate(w):
            places.setdefault(x, []).append(i)
        found = set()
        for window, names in windows.items():
            if names <= found or any(x not in places for x in window):
                continue
            rare = min(range(len(window)), key=lambda i: len(places[window[i]]))
            if any(all(any(abs(q - (p - rare + i)) <= slop for q in places[x]) for i, x in enumerate(window)) for p in places[window[rare]]):
                found |= names
        out[d] = found
    return out


def fingerprint(text, n=3):
    w = WORD.findall((text or "").translate(UPPER))
    if not w:
        return 0
    grams = [" ".join(w[i: i + n]) for i in range(len(w) - n + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, max_bits=3):
    """{doc_id: component_id} from {doc_id: fingerprint}, all pairs compared."""
    ids = sorted(fps)
    parent = {d: d for d in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= max_bits:
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {d: root(d) for d in ids}


def token_files(docs, path, end_id=1):
    """{doc_id: (start, n_tokens, ids_crc32)}; ids must be distinct"""
    import struct
    import zlib

    from tokenizers import Tokenizer
    tokenizer, start, out = Tokenizer.from_file(path), 0, {}
    for d, text in sorted(docs, key=lambda r: r[0]):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        out[d] = (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)
    return out


def url_rule(url, rules):
    """(host, path, longest rule or None); rules are texts like example.net/en/"""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = host.translate(UPPER)
    fits = [r for r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
            and path.startswith(r[r.index("/"):])]
    return host, path, max(fits, key=len, default=None)
