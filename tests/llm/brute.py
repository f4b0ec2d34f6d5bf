"""Plain versions of the operators, by the words of their contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def repeated_words(docs: list[tuple[int, str | None]], width: int = 50) -> list[tuple]:
    words = [(doc, WORD.findall(text or "")) for doc, text in docs]
    least: dict[tuple, int] = {}
    for doc, own in words:
        for i in range(len(own) - width + 1):
            window = tuple(own[i : i + width])
            least[window] = min(least.get(window, doc), doc)
    rows = []
    for doc, own in words:
        gone = set()
        for i in range(len(own) - width + 1):
            if least[tuple(own[i : i + width])] < doc:
                gone.update(range(i, i + width))
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        rows.append((doc, len(own), len(gone), sha(kept)))
    return sorted(rows)


def repeated_bytes(docs: list[tuple[int, str | None]], width: int = 200) -> list[tuple]:
    data = [(doc, (text or "").encode()) for doc, text in docs]
    count: dict[bytes, int] = {}
    for _, own in data:
        for i in range(len(own) - width + 1):
            count[own[i : i + width]] = count.get(own[i : i + width], 0) + 1
    rows = []
    for doc, own in data:
        gone = bytearray(len(own) + 1)
        for i in range(len(own) - width + 1):
            if count[own[i : i + width]] > 1:
                gone[i : i + width] = b"\x01" * width
        spans = sum(1 for i in range(len(own)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for i, b in enumerate(own) if not gone[i])
        rows.append((doc, len(own), sum(gone), spans, sha(kept)))
    return sorted(rows)


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def personal(doc: int, text: str | None) -> tuple:
    found = {}
    for kind, pattern in PII:
        spans = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and _luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append(f"{kind}:{m.start()}:{m.end()}")
        found[kind] = spans
    written = ",".join(s for spans in found.values() for s in spans)
    return (doc, *(len(s) for s in found.values()), sha(written))


def fingerprint(text: str | None, shingle: int = 4) -> int:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(docs: list[tuple[int, str | None]], radius: int = 4) -> list[tuple]:
    prints = [(doc, fingerprint(text)) for doc, text in docs]
    parent = list(range(len(prints)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(prints):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted((doc, f"{f:016x}", least[root(i)]) for i, (doc, f) in enumerate(prints))


def base_failed(text: str | None) -> bool:
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count: dict[tuple, int] = {}
    for window in windows:
        count[window] = count.get(window, 0) + 1
    repeated = {j for i, window in enumerate(windows) if count[window] > 1 for j in range(i, i + 8)}
    return len(words) < 20 or 100 * len(repeated) > 30 * len(words)


def without_lines(docs: list[tuple[int, str | None]]) -> list[tuple[int, str]]:
    def key(line: str) -> str:
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    least: dict[str, int] = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            least[key(line)] = min(least.get(key(line), doc), doc)
    return [
        (doc, "\n".join(x for x in (text or "").split("\n") if len(key(x)) < 10 or least[key(x)] == doc))
        for doc, text in docs
    ]


def normal_words(text: str | None) -> list[str]:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def contaminated(text: str | None, items: list[str | None]) -> bool:
    words, hit = normal_words(text), set()
    for item in items:
        own = normal_words(item)
        for i in range(max(1, len(own) - 12) if own else 0):
            window = own[i : i + 13]
            for j in range(len(words) - len(window) + 1):
                if words[j : j + len(window)] == window:
                    hit.update(range(j, j + len(window)))
    return bool(hit) and 20 * len(hit) >= len(words)


def manifest(rows: list[tuple]) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of (doc_id, source, lang, n_chars, text)."""

    def leaf(row) -> str:
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def levels(digests: list[str]) -> list[list[str]]:
        out = [digests]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
        return out

    def climb(tree, place, own):
        proof = ""
        for level in tree[:-1]:
            run = list(range(place - place % 3, min(place - place % 3 + 3, len(level))))
            proof += "".join(level[i] for i in run if i != place)
            own = sha("".join(own if i == place else level[i] for i in run))
            place //= 3
        return proof, own

    sources: dict = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        sources[name].sort(key=lambda r: (r[0] is None, r[0] or 0, leaf(r)))
    trees = {name: levels([leaf(row) for row in sources[name]]) for name in names}
    top = levels([trees[name][-1][0] for name in names])
    out = []
    for number, name in enumerate(names):
        for place, row in enumerate(sources[name]):
            bent = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                bent = (*row[:4], row[4].replace("\n", ""))
            low, folded = climb(trees[name], place, leaf(bent))
            high, folded = climb(top, number, folded)
            root = top[-1][0]
            out.append((row[0], leaf(row), trees[name][-1][0], root, sha(low + high), folded, folded == root))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def collocations(rows: list[tuple[str | None, str | None]], least: int = 30, top: int = 2000) -> list[tuple]:
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text)."""
    counts: dict[str, dict[tuple, int]] = {}
    totals: dict[str, int] = {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] = totals.get(lang, 0) + len(words)
            own = counts.setdefault(lang, {})
            for i in range(len(words)):
                for size in range(1, min(4, len(words) - i) + 1):
                    own[tuple(words[i : i + size])] = own.get(tuple(words[i : i + size]), 0) + 1
    out = []
    for lang, own in counts.items():
        candidates = {p: f for p, f in own.items() if f >= least and len(p) > 1}
        inside: dict[tuple, int] = {}
        for p, f in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside.get(p[i : i + size], 0), f)
        found = []
        for p, a in candidates.items():
            score, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            if 100 * inside.get(p, 0) < 80 * a:
                found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def segmentations(text: str, pieces: dict[str, float], byte: list[float]) -> list[tuple[float, list]]:
    """Every way to spell a text by pieces or by the bytes of single characters, with its probability."""
    if not text:
        return [(1.0, [])]
    out = []
    steps = [(text[:n], pieces[text[:n]]) for n in range(1, len(text) + 1) if text[:n] in pieces]
    by_bytes = 1.0
    for b in text[0].encode():
        by_bytes *= byte[b]
    for piece, p in [*steps, (text[0].encode(), by_bytes)]:
        out += [(p * q, [piece, *rest]) for q, rest in segmentations(text[len(piece) if isinstance(piece, str) else 1 :], pieces, byte)]
    return out
