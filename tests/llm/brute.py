"""Plain Python versions of the operators, for small tables."""

import hashlib
import math
import re
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def shingle_set(text, width=5):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def near_classes(rows, low=85, high=100):
    """{doc_id: (n_shingles, component_id, kept)} for (doc_id, text) rows."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}
    ids = sorted(i for i in sets if sets[i])
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if high * min(len(sets[a]), len(sets[b])) < low * max(len(sets[a]), len(sets[b])):
                continue
            common = len(sets[a] & sets[b])
            if high * common >= low * (len(sets[a]) + len(sets[b]) - common):
                ra, rb = find(parent, a), find(parent, b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(parent, i), find(parent, i) == i) for i in sets}


def exact_classes(rows):
    """{doc_id: (keep_id, group_size, kept, sha)} for (doc_id, text) rows with distinct ids."""
    groups = {}
    for i, t in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        groups.setdefault(bare, []).append((-len(t or ""), i))
    out = {}
    for bare, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            out[i] = (keep, len(members), i == keep, hashlib.sha256(bare.encode()).hexdigest())
    return out


def mix_targets(sizes, share=1.0, cap=3.0, weights=(5, 2, 1)):
    """{source: target} from {source: size}, sharing the excess in rounds."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    budget, fixed = share * sum(sizes.values()), {s: 0.0 for s in names if not sizes[s]}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        left, total = budget - sum(fixed.values()), sum(weight[s] for s in free)
        goal = {s: left * weight[s] / total for s in free}
        above = [s for s in free if goal[s] > cap * sizes[s]]
        if not above:
            return fixed | goal
        fixed |= {s: cap * sizes[s] for s in above}


def removed_bytes(rows, length=100):
    """{doc_id: list of removed flags} over (doc_id, text) rows."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        data = (t or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                gone[p : p + length] = [True] * length
            seen.add(window)
        out[i] = gone
    return out


def clusters(rows, k=16, rounds=3):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of (vec_id, vector) rows."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"1:{'null' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v in sorted((name(i), v) for i, v in kept)[:k]]
    for step in range(rounds + 1):
        found = []
        for _, v in kept:
            distances = [sum((x - y) ** 2 for x, y in zip(v, c)) for c in centres]
            found.append((distances.index(min(distances)), min(distances)))
        if step < rounds:
            for c in range(len(centres)):
                own = [v for (_, v), (w, _) in zip(kept, found) if w == c]
                if own:
                    centres[c] = [sum(column) // len(own) for column in zip(*own)]
    inertia = [sum(d for w, d in found if w == c) for c in range(len(centres))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, w, d, inertia[w], sum(inertia), shas[w]) for (i, _), (w, d) in zip(kept, found)]


def alignments(rows, path_a, path_b):
    """The contract's row for each (doc_id, text), by sets of byte ends."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    letters = {c: n for n, c in enumerate(map(chr, range(256))) if 33 <= n <= 126 or 161 <= n <= 172 or 174 <= n}
    letters |= {chr(256 + k): n for k, n in enumerate(n for n in range(256) if chr(n) not in letters)}

    def token_ends(parts):
        ends, at = [], 0
        for part in parts:
            at += len(part)
            ends.append(at)
        return ends

    links, out = [], []
    for _, text in rows:
        data = (" " + (text or "")).encode()
        ids_a, ids_b = a.encode(data.decode(), add_special_tokens=False).ids, b.encode(text or "")
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, map(b.id_to_piece, ids_b))]
        if not text or b"".join(bytes_a) != data or b"".join(bytes_b) != data:
            ids_a = ids_b = bytes_a = bytes_b = []
        ends_a, ends_b = token_ends(bytes_a), token_ends(bytes_b)
        groups, own = token_groups(ids_a, ids_b, ends_a, ends_b)
        links.append(own)
        text_groups = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((len(ids_a), len(ids_b), len(groups), len(own), hashlib.sha256(text_groups.encode()).hexdigest() if ids_a else ""))
    counts = Counter(pair for own in links for pair in own)
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(n, most.get(y, 0))
    return [
        (i, n_a, n_b, n_g, n_l, sum(counts[p] == most[p[1]] for p in own), sum(counts[p] for p in own), sha)
        for (i, _), own, (n_a, n_b, n_g, n_l, sha) in zip(rows, links, out)
    ]


def token_groups(ids_a, ids_b, ends_a, ends_b):
    groups, x, y = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        i, j = x, y
        while ends_a[x] < cut:
            x += 1
        while ends_b[y] < cut:
            y += 1
        x, y = x + 1, y + 1
        groups.append((ids_a[i:x], ids_b[j:y]))
    return groups, [(g[0][-1], g[1][-1]) for g in groups]
