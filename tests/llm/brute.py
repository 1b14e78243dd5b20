"""Plain Python versions of the queries' contracts."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import xxhash

from trendstats.llm.spotsigs import ANCHORS

PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SECRETS = {
    "assign": r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _pii_ok(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def _spans(text, patterns, ok, flags=0):
    out = []
    for k, (kind, p) in enumerate(patterns.items()):
        f = flags if kind == "assign" else 0
        out += [(m.start(), k, m.end(), kind) for m in re.finditer(p, text or "", f) if ok(kind, m)]
    out.sort()
    counts = Counter(x[3] for x in out)
    return [counts[k] for k in patterns], ",".join(f"{k}:{s}:{e}" for s, _, e, k in out)


def pii(text):
    """Counts by kind and the listed base spans."""
    return _spans(text, PII, lambda k, m: _pii_ok(k, m.group()))


def secrets(text):
    def ok(kind, m):
        return len(m.group(2)) >= 12 if kind == "assign" else len(m.group()) >= (18 if kind == "access" else 16)

    return _spans(text, SECRETS, ok, re.A | re.I)


def words3(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contamination(text, items, n=10):
    """n_words, n_hit, items_sha256, contaminated for (item_id, text) items."""
    words = words3(text)
    hit, names = set(), set()
    for item, body in items:
        w = words3(body)
        for at in range(max(1, len(w) - n + 1) if w else 0):
            window = w[at : at + n]
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    names.add("" if item is None else str(item))
    return len(words), len(hit), len(names), sha(",".join(sorted(names))), bool(hit)


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fingerprint(text):
    words = split_words(lower(text))
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, radius=3):
    """Class number of each fingerprint."""
    distinct = sorted(set(fps))
    parent = {f: f for f in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    return [find(f) for f in fps]


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Target of each source (dict source -> size)."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    held, budget = {}, share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in held]
        if not free:
            return held
        rate = (budget - sum(held.values())) / sum(weight[s] for s in free)
        over = [s for s in free if rate * weight[s] >= most * sizes[s]]
        if not over:
            return held | {s: rate * weight[s] for s in free}
        held |= {s: most * sizes[s] for s in over}


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return lower(host), re.match(r"[^?#]*", rest[len(host) :]).group()


def rule(url, rules):
    host, path = host_path(url)
    fit = [(len(h + p), v == "allow", h + p, v) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[2:] if fit else (None, None)


def edited(text, other):
    k = len(text) // 2
    return text[: len(text) - k] + other[:k]


def backoff_scores(texts, min_count=1, less=0):
    """(n_words, n_seen, score) of each text; ``less`` comes off the counts."""
    docs = [(t or "").encode().lower().split() for t in texts]
    uni = Counter(w for ws in docs for w in ws)
    uni[None] = sum(1 for ws in docs if ws)
    total = sum(map(len, docs))
    pairs = Counter(p for ws in docs for p in zip([None, *ws], ws))
    out = []
    for ws in docs:
        score = seen = 0
        for p in zip([None, *ws], ws):
            if pairs[p] - less >= min_count:
                score, seen = score + math.log((pairs[p] - less) / (uni[p[0]] - less)), seen + 1
            else:
                score += math.log(0.4 * uni[p[1]] / total)
        out.append((len(ws), seen, score))
    return out


def repeats(texts, least=200):
    """Per text: bytes, bytes that go, runs that go, hash of the rest."""
    data = [(t or "").encode() for t in texts]
    starts = Counter(d[i : i + least] for d in data for i in range(len(d) - least + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - least + 1):
            if starts[d[i : i + least]] > 1:
                gone[i : i + least] = b"\x01" * least
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(c for c, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def hard_negatives(rows, k=5):
    """Rows are (id, label, vector); labels as the query changes them."""
    usable = []
    for i, label, vec in rows:
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        usable.append((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * x) for x in vec]))
    out = []
    last = lambda i: (i is None, i or 0)
    for i, label, vec in usable:
        if i is None or i % 100:
            continue
        scored = [(sum(x * y for x, y in zip(vec, v)), j, other) for j, other, v in usable if j != i]
        scored.sort(key=lambda s: (-s[0], last(s[1])))
        for p, j, _ in [s for s in scored if s[2] == label][:k]:
            found = [s for s in scored if s[2] != label and 80 * p <= 100 * s[0] <= 100 * p][:k]
            out += [(i, j, at + 1, n, p, score) for at, (score, n, _) in enumerate(found)]
    return out


def token_tables(a_json, model):
    """Bytes of every id of the two tokenizers."""
    import json

    spec = json.loads(a_json)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    a = {i: bytes(chars[c] for c in t) for t, i in spec["model"]["vocab"].items() if all(c in chars for c in t)}
    b = {}
    for i in range(model.get_piece_size()):
        name = model.id_to_piece(i)
        b[i] = bytes.fromhex(name[3:5]) if model.is_byte(i) else name.replace("▁", " ").encode()
    return a, b


def alignment(texts, a_json, b_model):
    """Per text: A tokens, B tokens, groups, links, best links, count sum and
    the groups' text; and the links and documents of every pair."""
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(a_json.decode())
    tok.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_proto=b_model)
    bytes_a, bytes_b = token_tables(a_json, model)
    found = []
    for text in texts:
        ids = ([], [])
        if text:
            ids = (tok.encode(" " + text, add_special_tokens=False).ids, model.encode(text))
            want = (" " + text).encode()
            if b"".join(bytes_a[i] for i in ids[0]) != want or b"".join(bytes_b[i] for i in ids[1]) != want:
                ids = ([], [])
        groups, links, a, b, end_a, end_b = [], [], [], [], 0, 0
        left_a, left_b = list(ids[0]), list(ids[1])
        while left_a or left_b:
            if end_a <= end_b:
                a.append(left_a.pop(0))
                end_a += len(bytes_a[a[-1]])
            else:
                b.append(left_b.pop(0))
                end_b += len(bytes_b[b[-1]])
            if a and b and end_a == end_b:
                groups.append(",".join(map(str, a)) + "|" + ",".join(map(str, b)))
                links.append((a[-1], b[-1]))
                a, b = [], []
        found.append((len(ids[0]), len(ids[1]), links, ";".join(groups)))
    counts = Counter(x for _, _, links, _ in found for x in links)
    docs = Counter(x for _, _, links, _ in found for x in set(links))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    rows = [
        (n_a, n_b, len(links), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), groups)
        for n_a, n_b, links, groups in found
    ]
    return rows, {x: (n, docs[x], n == most[x[1]]) for x, n in counts.items()}


def label_model(rows, voters, rounds=4):
    """Prior, accuracies, correlations, weights and posterior function of
    the label model of ``(votes, label or None)`` rows, a row at a time."""

    def logit(p):
        p = min(max(p, 1e-4), 1 - 1e-4)
        return math.log(p / (1 - p))

    labels = [y for _, y in rows if y is not None]
    prior = (sum(labels) + 0.5) / (len(labels) + 1)
    accuracy = []
    for v in range(voters):
        own = [y for f, y in rows if v in f and y is not None]
        accuracy.append((sum(own) + 2 * prior) / (len(own) + 2))
    rho, weight = [], [1.0] * voters

    def posterior(fired):
        return 1 / (1 + math.exp(-(logit(prior) + sum(weight[v] * (logit(accuracy[v]) - logit(prior)) for v in fired))))

    for _ in range(rounds):
        mass = [posterior(f) if y is None else float(y) for f, y in rows]
        total = sum(mass)
        p = [sum(m for m, (f, _) in zip(mass, rows) if v in f) / total for v in range(voters)]
        spread = [math.sqrt(max(x * (1 - x), 1e-9)) for x in p]
        rho = [
            [
                1.0 if i == j else
                (sum(m for m, (f, _) in zip(mass, rows) if i in f and j in f) / total - p[i] * p[j]) / (spread[i] * spread[j])
                for j in range(voters)
            ]
            for i in range(voters)
        ]
        new = [(p[v] * total + 2 * prior) / (sum(v in f for f, _ in rows) + 2) for v in range(voters)]
        weight = [1 / sum(min(x, 1.0) for x in r if x >= 0.5) for r in rho]
        accuracy = new
    return prior, accuracy, rho, weight, posterior


def spot_signatures(text, chain=3):
    """Signatures of a text, 16 hex digits each: an anchor's hash continued
    over the content words that follow it."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())

    def hashed(parts):
        h = 42
        for part in parts:
            h = xxhash.xxh64_intdigest(part.encode(), seed=h)
        return f"{h:016x}"

    common, out, after = set(ANCHORS), set(), []
    for word in reversed(words):  # ``after``: the next content words
        if word not in common:
            after = [word, *after][:chain]
        elif len(after) == chain:
            out.add(hashed([word, *after]))
    if not out and text:
        out = {hashed([" ".join(words) if words else text])}
    return frozenset(out)


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0
