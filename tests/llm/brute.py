"""Plain versions of the operators, a row at a time, for small tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode())


def fingerprint(text: str | None) -> int:
    w = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(rows: list[tuple]) -> list[tuple]:
    """(doc_id, fingerprint, component_id) by all pairs."""
    fps = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                group[max(top(i), top(j))] = min(top(i), top(j))
    least: dict = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return [(d, f"{fps[i]:016x}", least.get(top(i))) for i, (d, _) in enumerate(rows)]


def quality(text: str | None) -> dict:
    w, s = words(text), text or ""
    n = len(w)

    def covered(k: int) -> int:
        grams: dict = {}
        for i in range(n - k + 1):
            grams.setdefault(tuple(w[i : i + k]), []).append(i)
        return len({x for at in grams.values() if len(at) > 1 for i in at for x in range(i, i + k)})

    longest = max((k for k in range(5, n + 1) if covered(k)), default=0) if n < 400 else None
    lines = [x for x in s.split("\n") if WORD.search(x.encode())]
    repeat = covered(8)
    return {
        "n_words": n, "word_chars": sum(len(x.decode()) for x in w), "n_symbols": len(re.findall(r"[#*$%&|<>]", s)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeat,
        "base_failed": n < 20 or 100 * repeat > 30 * n, "n_covered_words": covered(5), "longest_repeat": longest,
    }


def luhn(d: str) -> bool:
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    t, out = text or "", []
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15),
    }
    for k, (kind, (rule, good)) in enumerate(rules.items()):
        out += [(m.start(), k, m.end(), kind) for m in re.finditer(rule, t) if good(m[0])]
    return [(a, b, kind) for a, _, b, kind in sorted(out)]


def pages(rows: list[tuple]) -> list[tuple]:
    best: dict = {}
    for i, h in rows:
        best[h or ""] = max(i, best.get(h or "", i))
    out = []
    for i, h in rows:
        raw, first = (h or "").encode(), best[h or ""]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((i, len(raw), digest, "response" if i == first else "revisit", None if i == first else first))
    return out


def tokens(rows: list[tuple], path: str) -> list[tuple]:
    import numpy as np
    from tokenizers import Tokenizer

    tokenizer, at, out = Tokenizer.from_file(path), 0, []
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out
