"""Plain versions of the operators, and documents with every odd case."""

import hashlib
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, fingerprint string, row int, text_ string"

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards box five very jolly green frogs "
ODD_TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "one",
    "one two",
    "one two three",
    PROSE * 3,
    PROSE * 3,
    (PROSE * 3).upper(),
    "\n".join(f"line {k} is here" for k in range(30)) + "\nline 3 is here\n\nline 3 is here\r",
    "a\x1cb c\x85d e f g",
    "Größe ÉTÉ naïve 日本語 😀 mail me: Ann.Lee+x@mail.example.com or +1 (489) 555-0950, from 10.0.0.1 not 10.0.0.256",
    "card 4111 1111 1111 1111 and 4111 1111 1111 1112, iban DE89 3704 0044 0532 0130 00, ssn 123-45-6789",
    "it's <|endoftext|>x<|startoftext|> don't ''' 's",
    " ".join(f"w{k % 997}" for k in range(40_000)),
    "Licensed under the MIT License.\nprose follows here and goes on",
]


def documents(spark, texts=ODD_TEXTS):
    rows = [(k, t, "en", f"src{k % 3}", len(t or ""), 7, "clash", 1, "x") for k, t in enumerate(texts)]
    rows += [rows[min(6, len(rows) - 1)], (None, PROSE * 3, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return (text or "").translate(LOWER)


def measures(text):
    body, own = text or "", words(text)
    windows = Counter(zip(own, own[1:], own[2:]))
    covered = {i + k for i in range(len(own) - 2) if windows[tuple(own[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in body.split("\n") if WORD.search(line)]
    return (
        len(own),
        sum(map(len, own)),
        len(re.findall(r"[#*$%&|<>]", body)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def fingerprint(text):
    own = words(lower(text))
    shingles = [" ".join(own[i : i + 3]) for i in range(len(own) - 2)] if len(own) > 2 else [" ".join(own)] * bool(own)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(links, nodes):
    """The smallest node reachable from each."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def base_spans(text):
    """Base kinds by the plain expressions of the contract."""
    text, found = text or "", []

    def luhn(d):
        return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0

    digits = lambda s: re.sub(r"[^0-9]", "", s)
    tests = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "email", lambda s: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "ip", lambda s: all(int(p) <= 255 for p in s.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", "card", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", "phone", lambda s: 10 <= len(digits(s)) <= 15),
    )
    for order, (pattern, kind, good) in enumerate(tests):
        found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if good(m[0])]
    return [span for _, _, span in sorted(found)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def pieces(ids, room=2048):
    import numpy as np

    own = np.array([*ids, 1], dtype="<u4")
    return [(at, len(own[at : at + room]), zlib.crc32(own[at : at + room].tobytes()), len(own)) for at in range(0, len(own), room)]
