"""Plain versions of the operators, for small inputs."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import tiktoken


def fold(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5


def sha(data):
    return hashlib.sha256(data).hexdigest()


def op1(texts, length=400):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(r), sum(gone), runs, sha(bytes(b for b, g in zip(r, gone) if not g))))
    return out


def op2(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def op4(rows):
    split = {i: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), "\n"] for i, (d, t) in enumerate(rows)}
    counts, pairs = Counter(), Counter()
    for i, (d, _) in enumerate(rows):
        if fold(d) != 1:
            counts.update(split[i])
            pairs.update(zip(["\t", *split[i]], split[i]))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, (d, _) in enumerate(rows):
        p = lambda w: (counts[w] + 0.5) / (n + 0.5 * (v + 1))
        base = sum(math.log10(p(w)) for w in split[i])
        score, k = 0, 20.0
        for a, b in zip(["\t", *split[i]], split[i]):
            of = counts["\n" if a == "\t" else a]
            score += math.log10((pairs[a, b] + k * p(b)) / (of + k))
        out.append((d, fold(d) == 1, len(split[i]), sum(counts[w] > 0 for w in split[i]), n, base, score))
    return out


WORD5 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def op5(texts, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        w = re.findall(WORD5, lower(text))
        for i in range(max(1, len(w) - size + 1)):
            if w:
                windows[tuple(w[i:i + size])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        w, hit, found = re.findall(WORD5, lower(text)), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit)))
    return out


def encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


BASE8 = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def op8(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE8.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def op9(texts, size=5, least=0.8):
    sets = []
    for t in texts:
        w = lower(t).encode().split()
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else None)
    n = len(texts)
    parent, links = list(range(n)), [0] * n

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a is None or b is None or min(len(a), len(b)) < least * max(len(a), len(b)):
                continue
            common = len(a & b)
            if common >= least * (len(a) + len(b) - common) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(n)], links
