"""What each query must return, worked out in the plainest way from rows ``(doc_id, text)``."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PRINTED = re.compile(r"[^\x20\x09-\x0D]+")
ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")


def encoder(name):
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: out.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def pieces(rows, capacity=2048):
    encode = encoder("word_bpe_49k.json")
    for doc_id, text in rows:
        ids = [*encode(text), 0]
        for k in range(0, len(ids), capacity):
            yield doc_id, k // capacity, k, len(ids[k : k + capacity]), crc(ids[k : k + capacity])


def shingles(text, size):
    words = PRINTED.findall(lower(text))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def linked(rows, size=4, num=85, den=100):
    """Per row: the size of its set, and the row numbers of its component."""
    sets = [shingles(t, size) for _, t in rows]
    held, parent = defaultdict(list), list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, own in enumerate(sets):
        both = Counter(o for s in own for o in held[s])
        for o, n in both.items():
            if den * n >= num * (len(own) + len(sets[o]) - n):
                a, b = find(k), find(o)
                parent[max(a, b)] = min(a, b)
        for s in own:
            held[s].append(k)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(k)
    return sets, [groups[find(k)] for k in range(len(rows))]


def components(rows, **options):
    sets, groups = linked(rows, **options)
    out = []
    for k, (doc_id, _) in enumerate(rows):
        ids = [rows[g][0] for g in groups[k] if rows[g][0] is not None]
        out.append((doc_id, len(sets[k]), doc_id if not sets[k] else min(ids, default=None)))
    return out


def repeats(texts, length=400):
    """Per text, a mask of its bytes within strings that start anywhere else too."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    for b in data:
        mask = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mask[i : i + length] = True
        yield b, mask


def deduplicated(rows, length=400):
    for (doc_id, _), (b, mask) in zip(rows, repeats([t for _, t in rows], length), strict=True):
        spans = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        kept = hashlib.sha256(np.frombuffer(b, np.uint8)[~mask].tobytes()).hexdigest()
        yield doc_id, len(b), int(mask.sum()), spans, kept


def base_quality(rows):
    for doc_id, text in rows:
        words, seen, dup = PRINTED.findall(text or ""), set(), 0
        for line in (text or "").split("\n"):
            if PRINTED.search(line):
                dup += line in seen
                seen.add(line)
        grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        yield doc_id, len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def kept_by_lines(rows, share=0.10, least_docs=50, least_kept=0.4, least_words=10):
    """Verdicts for rows ``(doc_id, text, source)``."""
    holders, hosts = defaultdict(set), defaultdict(set)

    def lines(text):
        return [tuple(w) for w in (PRINTED.findall(lower(x)) for x in (text or "").split("\n")) if w]

    for _, text, source in rows:
        hosts[source or ""].add(text or "")
        for line in lines(text):
            holders[source or "", line].add(text or "")
    for (_, text, source), base in zip(rows, base_quality([r[:2] for r in rows]), strict=True):
        host = source or ""
        common = {x for x in lines(text) if len(holders[host, x]) > max(least_docs, share * len(hosts[host]))}
        n = base[1]
        left = n - sum(len(x) for x in lines(text) if x in common)
        yield not base[6] and left >= least_words and left >= least_kept * n


def contaminated(rows, items, size=10):
    """Per row: words, the numbers of hit words, and the ids of items found."""
    owners = defaultdict(set)
    for item, text in items:
        words = ALPHANUMERIC.findall(lower(text))
        n = min(size, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            owners[tuple(words[k : k + n])].update([] if item is None else [str(item)])
    lengths = {len(w) for w in owners}
    for doc_id, text in rows:
        words, hit, found = ALPHANUMERIC.findall(lower(text)), set(), set()
        for n in lengths:
            for k in range(len(words) - n + 1):
                if (w := tuple(words[k : k + n])) in owners:
                    hit.update(range(k, k + n))
                    found |= owners[w]
        yield doc_id, len(words), hit, found


def leaks(rows, items):
    for doc_id, n, hit, found in contaminated(rows, items):
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        yield doc_id, n, len(hit), len(found), digest, bool(hit)


class Katz:
    """The model of katz.py as its docstring has it, with dictionaries."""

    def __init__(self, rows):
        from tidemark.llm.katz import discounts

        self.words, self.pairs, self.heads = Counter(), Counter(), Counter()
        self.docs = [(d, [*PRINTED.findall(lower(t)), "</s>"], d is not None and zlib.crc32(str(d).encode()) % 5 == 1) for d, t in rows]
        for _, words, held in self.docs:
            if not held:
                self.words.update(words)
                self.pairs.update(zip(["<s>", *words], words, strict=False))
                self.heads.update(["<s>", *words[:-1]])
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.by_word, self.by_pair = discounts(Counter(self.words.values())), discounts(Counter(self.pairs.values()))
        kept = sum(c * (1 - self.by_word[c]) for c in self.words.values() if c <= 5)
        self.unknown = max(kept / self.n, 1 / (self.n + 1)) if self.n else 1.0
        self.scale = (1 - self.unknown) / (1 - kept / self.n) if self.n else 1.0
        seen = defaultdict(list)
        for (h, w), c in self.pairs.items():
            seen[h].append((w, c))
        self.weights = {}
        for h, own in seen.items():
            mass = sum(self.discounted(c, self.by_pair) for _, c in own) / self.heads[h]
            left = max(1 - mass, 1 / (self.heads[h] + 1))
            self.weights[h] = left / (1 - sum(self.word(w) for w, _ in own)), (1 - left) / mass

    def discounted(self, count, by):
        return count if count > 5 else by[count] * count

    def word(self, w):
        return self.discounted(self.words[w], self.by_word) * self.scale / self.n if self.words[w] else self.unknown

    def p(self, h, w):
        if self.pairs[h, w]:
            return self.discounted(self.pairs[h, w], self.by_pair) * self.weights[h][1] / self.heads[h]
        return self.weights.get(h, (1.0, 1.0))[0] * self.word(w)

    def rows(self):
        for doc_id, words, held in self.docs:
            base = sum(math.log10((self.words[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in words)
            score = sum(math.log10(self.p(h, w)) for h, w in zip(["<s>", *words], words, strict=False))
            yield doc_id, held, len(words), sum(self.words[w] > 0 for w in words), self.n, round(base, 6), round(score, 6)


def prefix_nodes(rows):
    """Rows ``(conv_id, turn, role, text)``; equal turns of one conversation come in the order of their digests."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv_id].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        origin = c - int(math.fmod(c, 20))
        turns = (*own.get(origin, [])[:h], *own[c][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        words = len(PRINTED.findall(path[-1][1])) if path else 0
        saved[path] = (len(members[path]) - 1) * words + sum(saved[c] for c in children[path])
        leaves[path] = sum(leaves[c] for c in children[path]) or 1
    for path, m in members.items():
        parent = members[path[:-1]][0] if path else None
        digest = hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest()
        yield m[0], len(path), parent, len(m), len(children[path]), leaves[path], saved[path], digest


def token_counts(rows):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    for doc_id, text in rows:
        n = len(encode(text or "", add_special_tokens=False).ids)
        yield doc_id, len((text or "").encode()), n, n > 1024


def whitened(rows, wanted=16):
    """Rows ``(vec_id, vector)``: per usable row its deviation and whitened values, in doubles; n; shares of the variance."""
    rows = [(v, [math.floor(64 * c) + 1_000_000 for c in e]) for v, e in rows if e is not None and all(c is not None and math.isfinite(c) for c in e)]
    x = np.array([e for _, e in rows], np.int64)
    points = np.unique(x, axis=0)
    n, total = len(points), points.sum(0)
    centred = (n * points - total) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    keep = [k for k in range(len(values))[::-1] if values[k] > 1e-9 * values[-1]][:wanted]
    deviations = n * x - total
    return [v for v, _ in rows], (deviations**2).sum(1).tolist(), deviations / n @ vectors[:, keep] / np.sqrt(values[keep]), n, values[keep] / values.sum()
