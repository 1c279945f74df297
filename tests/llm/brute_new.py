"""Plain versions of the contracts of conversation repair and ranked search."""

import hashlib
import heapq
import math
import re
import struct
import zlib
from itertools import product

import numpy as np
import xxhash

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def damaged(rows):
    """rows: [(conv_id, turn, role, text)]. The rows after damage, copies next to each other."""
    space = lambda x: " " if x is None else str(x)
    out = []
    for conv, turn, role, text in rows:
        what = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if what == 1:
            text = ""
        elif what == 2:
            text = re.sub("[.!?]", "", text)
        elif what == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(what, 1)
    return out


def _legal(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def cheapest(rows, most_inserts=3):
    """rows: [(role, text, must go, truncated)]. (cost, audit, repaired turns) by trying every edit string."""
    best = None
    for letters in product("DKR", repeat=len(rows)):
        if any(gone and x != "D" for x, (_, _, gone, _) in zip(letters, rows)):
            continue
        base = sum({"D": 2, "K": 0, "R": 1}[x] + (5 if x != "D" and cut else 0) for x, (_, _, _, cut) in zip(letters, rows))
        for n in range(most_inserts + 1):
            if best is not None and base + 5 * n > best[0]:
                break
            for slots in _places(len(rows) + 1, n):
                audit = "".join("I" * slots[k] + (letters[k] if k < len(rows) else "") for k in range(len(rows) + 1))
                if best is not None and (base + 5 * n, audit) >= best[:2]:
                    continue
                for turns in _roles(audit, rows):
                    best = (base + 5 * n, audit, turns)
                    break
    return best


def _places(slots, n):
    if slots == 1:
        yield (n,)
        return
    for first in range(n + 1):
        for rest in _places(slots - 1, n - first):
            yield (first, *rest)


def _roles(audit, rows):
    at, open_turns = 0, []
    for x in audit:
        if x == "I":
            open_turns.append((None, ""))
            continue
        role, text = rows[at][:2]
        at += 1
        if x != "D":
            open_turns.append((role if x == "K" else None, text))
    free = [k for k, (role, _) in enumerate(open_turns) if role is None]
    for names in product(("user", "assistant"), repeat=len(free)):
        turns = list(open_turns)
        for k, name in zip(free, names):
            turns[k] = (name, turns[k][1])
        if _legal("".join(role[:1] or "-" for role, _ in turns)):
            yield turns


def repaired(rows, original):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256)} of damaged rows."""
    out = {}
    for conv in {r[0] for r in original}:
        mine = [r[1:] for r in rows if r[0] == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, judged, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        for _, role, text in mine:
            bare = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, _, _ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, kept = cheapest(judged)
        sha = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in kept).encode()).hexdigest()
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, sha)
    return out


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def ranked(docs, items, k=20):
    """docs: [(doc_id, text)], items: [(item_id, text)]. {item_id: [(doc_id, score)]}"""
    bags = [(i, terms(t)) for i, t in docs]
    bags = [(i, t) for i, t in bags if t]
    n_all, l_all, df = len(bags), sum(len(t) for _, t in bags), {}
    for _, t in bags:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    weight = {x: math.floor(1000 * math.log((2 * n_all + 2) / (2 * d + 1))) for x, d in df.items()}
    tf = []
    for i, t in bags:
        c = {}
        for x in t:
            c[x] = c.get(x, 0) + 1
        tf.append((i, 75 + (25 * len(t) * n_all) // l_all, c))
    out = {}
    for item, text in items:
        query = terms(text)
        scores = []
        for i, m, c in tf:
            s = sum(weight[x] * (1_000_000_000 * c[x] // (1000 * c[x] + 12 * m)) for x in query if x in c)
            if s > 0:
                scores.append((-s, i))
        out[item] = [(i, -s) for s, i in heapq.nsmallest(k, scores)]
    return out


def random_tokens(docs, base, false_rate=0.01):
    """docs: [(doc_id, text)], base: {doc_id: [(kind, start, end)]}. {doc_id: [(start, end)]} that the battery calls random."""
    from exportlens.llm import secrets as S

    def lower_tail(z):
        t = 1 / (1 + 0.2316419 * abs(z))
        tail = math.exp(-z * z / 2) * 0.3989422804014327 * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return tail if z < 0 else 1 - tail

    def judge(token):
        bare = token.rstrip("=")
        k = next(k for k, (pattern, _) in enumerate(S.ENCODINGS) if re.search(pattern, bare))
        letters = S.ENCODINGS[k][1]
        n, size = len(bare), len(letters)
        chi, df = sum(bare.count(c) ** 2 for c in letters) * size / n - n, size - 1
        rate = size * 0.066 if letters in (S.LOWER, S.UPPER) else max(size * 0.066, 3.0)
        excess = n * (rate - 1)
        p = lower_tail((chi - df - excess) / math.sqrt(2 * (df + 2 * excess)))
        codes = [letters.index(c) if c in letters else -1 for c in bare]
        high = [c > (size - 1) / 2 for c in codes]
        n1 = sum(high)
        runs, expected = 1 + sum(a != b for a, b in zip(high, high[1:])), 2 * n1 * (n - n1) / n + 1
        variance = (expected - 1) * (expected - 2) / (n - 1)
        z_runs = abs(runs - expected) / math.sqrt(variance) if variance > 0 else 99
        mean = sum(codes) / n
        spread = sum((c - mean) ** 2 for c in codes)
        z_serial = abs(sum((a - mean) * (b - mean) for a, b in zip(codes, codes[1:])) / spread * n + 1) / math.sqrt(n) if spread > 0 else 99
        if "A" in letters and "a" in letters:
            kinds = [0 if c < 26 else 1 if c < 52 else 2 if c < 62 else 3 for c in codes]
            m = n - 1
            changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
            x = max(p * (1 - lower_tail((changes - 0.35 * m - 0.5) / math.sqrt(0.35 * 0.65 * m))), 1e-299)
            p = min(1.0, x * (1 - math.log(x)))
        return (p if z_runs <= 3.29 and z_serial <= 3.29 else 1.0), (k, min(int(math.log2(len(token))), 31))

    families, found = {}, {}
    for i, text in docs:
        for m in re.finditer(S.CANDIDATE, text or ""):
            if any(s < m.end() and m.start() < e for _, s, e in base[i]):
                continue
            p, family = judge(m.group())
            step = max(0, min(math.floor(-math.log10(max(p, 1e-299)) * 20), 6000))
            found.setdefault(i, []).append((m.start(), m.end(), step, family))
            families.setdefault(family, []).append(step)
    least = {}
    for family, steps in families.items():
        steps.sort(reverse=True)
        passed = [x for x in set(steps) if 10 ** (-x / 20) <= false_rate * sum(y >= x for y in steps) / len(steps)]
        if passed:
            least[family] = min(passed)
    return {i: [(s, e) for s, e, step, family in found.get(i, []) if family in least and step >= least[family]] for i, _ in docs}


def kept_by_quartiles(rows, metrics, fence, prior):
    """rows: [(lang, source, base_failed, {metric: value})]; metrics: {metric: (low, high)}. Whether each row is kept."""
    def quartiles(values):
        values = sorted(values)
        return len(values), [values[math.ceil(len(values) * q) - 1] for q in (0.25, 0.75)]

    def mixed(own, other):
        n, mine = own
        return n, [(a * n + b * prior) / (n + prior) for a, b in zip(mine, other[1])]

    limits = {}
    for m in metrics:
        good = [(r[0], r[1], r[3][m]) for r in rows if not r[2]]
        if not good:
            continue
        everything = quartiles([v for _, _, v in good])
        by_lang = {la: mixed(quartiles([v for a, _, v in good if a == la]), everything) for la in {g[0] for g in good}}
        for group in {g[:2] for g in good}:
            limits[group, m] = mixed(quartiles([v for a, b, v in good if (a, b) == group]), by_lang[group[0]])[1]
    out = []
    for la, so, failed, values in rows:
        ok = not failed
        for m, (low, high) in metrics.items():
            if not failed and ((la, so), m) in limits:
                q1, q3 = limits[(la, so), m]
                d = q3 - q1
                ok &= not (d > 0 and (low and values[m] < q1 - fence * d or high and values[m] > q3 + fence * d))
        out.append(ok)
    return out


def draw(doc_id, seed):
    """Number from 0 to 1 by the 64-bit XXH64 of id and seed, one after the other."""
    first = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42)
    return (xxhash.xxh64_intdigest(struct.pack("<i", seed), seed=first) >> 11) / 2**53


def mixture(rows, rare, miss, power=0.7, tolerance=1e-3, sweeps=40):
    """rows: [(doc_id, source, lang, topic, tokens)]. {doc_id: probability} by raking and the largest rate."""
    cells = {}
    for _, *key, n in rows:
        if n:
            cells[tuple(key)] = cells.get(tuple(key), 0) + n
    if not cells:
        return {r[0]: 1.0 for r in rows}
    tokens = sum(cells.values())

    def by(margin, values):
        out = {}
        for key, v in values.items():
            out[key[margin]] = out.get(key[margin], 0.0) + v
        return out

    def rake(targets, most=math.inf):
        weight, last = {k: float(n) for k, n in cells.items()}, math.inf
        for _ in range(sweeps):
            worst = 0.0
            for m, target in enumerate(targets):
                sums = by(m, weight)
                held = by(m, {k: w if w >= cells[k] * most * (1 - 1e-12) else 0.0 for k, w in weight.items()})
                factor = {}
                for v, s in sums.items():
                    aim = target.get(v, 0.0)
                    plain = aim / s if s > 0 else 0.0
                    if aim > 0 and s > 0:
                        worst = max(worst, abs(plain - 1))
                    factor[v] = (aim - held[v]) / (s - held[v]) if aim > s > held[v] else plain
                weight = {k: min(w * factor[k[m]], cells[k] * most) for k, w in weight.items()}
            if worst <= tolerance or worst > 0.99 * last:
                break
            last = worst
        return {k: w for k, w in weight.items() if w > 0}

    def tempered(m):
        powered = {v: t**power for v, t in by(m, cells).items()}
        return {v: t / sum(powered.values()) for v, t in powered.items()}

    aims = [tempered(m) for m in range(3)]
    weight = rake(aims)
    kept = sum(cells[k] for k in weight)
    least = min(1.0, sum(weight.values()) / (kept * max(w / cells[k] for k, w in weight.items())))

    def shares(of):
        t, w = [by(m, {k: cells[k] for k in of}) for m in range(3)], [by(m, of) for m in range(3)]
        return [{v: (t[m][v] / sum(t[m].values()), w[m][v] / sum(w[m].values())) for v in t[m]} for m in range(3)]

    def missed(goals, of):
        out = []
        for goal, share in zip(goals, shares(of)):
            whole = sum(goal[v] for v in share)
            out.append(sum(abs(goal[v] / whole - share[v][1]) for v in share) / 2)
        return out

    own, start = shares(weight), missed(aims, weight)

    def largest(m):
        upto = 0.0
        for ratio, v in sorted((own[m][v][0] / aims[m][v], v) for v in own[m]):
            upto += aims[m][v]
            if upto > rare:
                return min(1.0, ratio)
        return 1.0

    def reachable(m, rate):
        order = sorted((own[m][v][0] / aims[m][v], str(v), v) for v in own[m])
        full, rest = 0.0, 1.0
        for ratio, _, v in order:
            spare = (1 - full) / rest
            full, rest = full + own[m][v][0] / rate, rest - aims[m][v]
            if ratio / rate * rest + full >= 1 - 1e-12:
                return spare
        return spare

    now, chosen = max(least, min(map(largest, range(3)))), weight
    while now > least:
        goals = [{v: min(aims[m][v] * f, own[m][v][0] / now) for v in own[m]} for m in range(3) for f in [reachable(m, now)]]
        found = rake(goals, 1 / (kept * now))
        if all(a <= b + miss for a, b in zip(missed(goals, found), start)):
            chosen = found
            break
        now = max(least, now * 0.95)
    else:
        now = least
    total, whole = sum(cells[k] for k in chosen), sum(chosen.values())
    return {i: 1.0 if not n else min(1.0, chosen.get(tuple(key), 0.0) / cells[tuple(key)] * now * total / whole) for i, *key, n in rows}


def quality_scores(docs, labels):
    """{doc_id: score} of a factorisation machine fitted and scored with loops over inputs and pairs of inputs."""
    from exportlens.llm import classifier as C
    from exportlens.llm.common import word_cache

    cache, known = word_cache(), {}
    for i, y in labels:
        if y is not None and zlib.crc32(str(i).encode()) % 5:
            known[i] = max(y, known.get(i, y))
    inputs = {i: C.features((t or "").encode(), cache) for i, t in docs}
    train = [(inputs[i], known[i]) for i, _ in sorted(docs) if i in known]
    size, rng = C.BUCKETS + len(C.STATS), np.random.Generator(np.random.PCG64(5))
    v = rng.normal(0, 0.01, (size, C.FACTORS)).tolist()
    stats = np.stack([x[2] for x, _ in train])
    mean, spread = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-3)

    def pairs(x):
        own = np.clip((x[2] - mean) / spread, -4, 4)
        return [(int(k), float(w)) for k, w in zip(x[0], x[1])] + [(C.BUCKETS + k, float(w)) for k, w in enumerate(own)]

    share = min(max(sum(y for _, y in train) / len(train), 1e-3), 1 - 1e-3)
    bias, linear = math.log(share / (1 - share)), [0.0] * size
    bias_sum, linear_sum, v_sum = 1e-8, [1e-8] * size, [[1e-8] * C.FACTORS for _ in range(size)]

    def chance(z):
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def output(xs):
        # Sum over factors of all products of two inputs, by the running sum of those before each.
        z = bias + sum(linear[k] * w for k, w in xs)
        for f in range(C.FACTORS):
            upto = 0.0
            for k, w in xs:
                z += v[k][f] * w * upto
                upto += v[k][f] * w
        return z

    rows = [(pairs(x), y) for x, y in train]
    for _ in range(12):
        for i in rng.permutation(len(rows)):
            xs, y = rows[i]
            error = chance(output(xs)) - y
            sums = [sum(v[k][f] * w for k, w in xs) for f in range(C.FACTORS)]
            for k, w in xs:
                g = error * w + 1e-4 * linear[k]
                linear_sum[k] += g * g
                linear[k] -= 0.05 * g / math.sqrt(linear_sum[k])
                for f in range(C.FACTORS):
                    g = error * (w * sums[f] - v[k][f] * w * w) + 1e-4 * v[k][f]
                    v_sum[k][f] += g * g
                    v[k][f] -= 0.05 * g / math.sqrt(v_sum[k][f])
            bias_sum += error * error
            bias -= 0.05 * error / math.sqrt(bias_sum)
    return {i: chance(output(pairs(x))) for i, x in inputs.items()}
