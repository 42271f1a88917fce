"""More plain versions: code lengths, lines, chats, leaks, statistics and outliers."""

import math
import re
from collections import Counter, defaultdict

import numpy as np

from tests.llm.plain import id_of, words


def code_length(texts, text, order=3, start=b"\n"):
    """Bits of ``text`` by prediction by partial matching after ``texts``, with exclusions."""
    counts = defaultdict(Counter)
    for t in texts:
        raw = start * order + t.encode()
        for i in range(order, len(raw)):
            for k in range(order + 1):
                counts[raw[i - k : i]][raw[i]] += 1
    total, raw = 0.0, start * order + text.encode()
    for i in range(order, len(raw)):
        out = set()
        for k in range(order, -1, -1):
            seen = {s: c for s, c in counts.get(raw[i - k : i], {}).items() if s not in out}
            n, d = sum(seen.values()), len(seen)
            if raw[i] in seen:
                total -= math.log2(seen[raw[i]] / (n + d))
                break
            if n:
                total -= math.log2(d / (n + d))
            out |= set(seen)
        else:
            total += math.log2(256 - len(out))
    return total


def one_edit(a, b):
    """Whether two word lists are at most one inserted, deleted or replaced word apart."""
    if abs(len(a) - len(b)) > 1:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1] <= 1


def dedup_lines(rows, least=5):
    """{(doc_id, text): (n_lines, n_removed, text left)} for distinct (doc_id, text)."""
    docs = sorted(set(rows), key=lambda r: (id_of(r[0]), r[1] or ""))
    first = {}
    for doc_id, text in docs:
        for i, line in enumerate((text or "").split("\n")):
            if words(line):
                first.setdefault(tuple(words(line)), (id_of(doc_id), i))
    near = {
        x for x in first for y in first
        if min(len(x), len(y)) >= least and first[y] < first[x] and one_edit(x, y)
    }
    out = {}
    for doc_id, text in docs:
        left, n, gone = [], 0, 0
        for i, line in enumerate((text or "").split("\n")):
            key = tuple(words(line))
            n += bool(key)
            if key and (key in near or first[key] != (id_of(doc_id), i)):
                gone += 1
            else:
                left.append(line)
        out[doc_id, text] = n, gone, None if text is None else "\n".join(left)
    return out


def preferences(turns):
    """{pair_id: (n, prompt, chosen, spans, rejected, spans)} for (pair_id, chosen, turn, role, text)."""
    sides = defaultdict(lambda: (set(), set()))
    for pair, chosen, turn, role, text in turns:
        if pair is not None and chosen is not None:
            sides[pair][not chosen].add((id_of(turn), role or "", text or ""))

    def render(side):
        out, spans = "", []
        for _, role, text in side:
            out += f"<|im_start|>{role}\n"
            if role == "assistant":
                spans.append((len(out), len(text) + 11))
            out += f"{text}<|im_end|>\n"
        return out, spans

    found = {}
    for pair, both in sides.items():
        a, b = map(sorted, both)
        n = 0
        while n < min(len(a), len(b)) and a[n][1:] == b[n][1:]:
            n += 1
        found[pair] = n, render(a[:n])[0], *render(a[n:]), *render(b[n:])
    return found


def _terms(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def _shingles(own):
    k = min(5, len(own))
    return Counter(tuple(own[i : i + k]) for i in range(len(own) - k + 1))


def leaks(rows, items):
    """{(doc_id, item_id): best similarity} of 0.8 or more."""
    out = {}
    for doc_id, text in rows:
        own = _terms(text)
        for item_id, item in items:
            want = _terms(item)
            bag = _shingles(want)
            k = min(5, len(want))
            hits = [i for i in range(len(own) - k + 1) if tuple(own[i : i + k]) in bag] if want else []
            near = {j for i in hits for j in range(i - len(want) + k, i + 1)}  # else nothing is shared
            for i in sorted(j for j in near if 0 <= j <= len(own) - len(want)):
                window = _shingles(own[i : i + len(want)])
                alike = sum((bag & window).values()) / sum((bag | window).values())
                if alike >= 0.8:
                    out[doc_id, item_id] = max(out.get((doc_id, item_id), 0), alike)
    return out


def statistics(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    own = words(text)
    places = defaultdict(list)
    for i in range(len(own) - 4):
        places[tuple(own[i : i + 5])].append(i)
    again = {i + j for p in places.values() if len(p) > 1 for i in p for j in range(5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    n = len(own)
    return (n, sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(again), n < 10 or 100 * len(again) > 20 * n)


def outliers(rows, widths, grid, cover, fall, inside, rings, grow, within):
    """Distances of rows (group, statistics) by minimum covariance determinant, with numpy.

    ``grow`` multiplies the covariances of the half and of the inner part, ``within`` is the
    latter's squared distance."""
    groups = defaultdict(list)
    for i, (group, s) in enumerate(rows):
        n, chars, symbols, dup, repeat, failed = s
        x = (math.log(1 + n), chars / max(n, 1), math.sqrt(symbols / max(chars, 1)),
             math.log(1 + dup), repeat / max(n, 1))
        if not failed:
            groups[group].append((i, np.floor(np.array(x) * grid + 0.5)))
    out = {}
    least = np.array(widths) * grid
    floor = np.diag(least**2)

    def distance(x, mean, cov):
        z = np.linalg.solve(np.linalg.cholesky(cov), (x - mean).T)
        return (z * z).sum(axis=0)

    def estimate(own, k):
        return own.mean(axis=0), grow[k] * np.cov(own.T, bias=True) + floor

    for members in groups.values():
        x = np.unique([v for _, v in members], axis=0)
        ranked, half = np.sort(x, axis=0), -(-len(x) // 2) - 1
        q1, q2, q3 = (ranked[-(-q * len(x) // 4) - 1] for q in (1, 2, 3))
        away = np.maximum(np.sort(np.abs(x - q2), axis=0)[half] / 0.6745, least)
        v = (x - q2) / away
        v = v[(v != 0).any(axis=1)]
        signs = v / np.linalg.norm(v, axis=1, keepdims=True)
        shape = len(widths) * signs.T @ signs / max(1, len(v)) * np.outer(away, away)
        best = None
        for start in (np.diag(np.maximum((q3 - q1) / 1.349, least) ** 2), np.diag(away**2), shape + floor):
            mean, cov, det = q2, start, math.inf
            while True:
                ring = np.floor(np.log(distance(x, mean, cov) + 1e-3) * rings)
                after = estimate(x[ring <= np.sort(ring)[math.ceil(cover * len(x)) - 1]], 0)
                new = np.linalg.det(after[1] / grid**2)
                if new >= det * (1 - fall):
                    break
                (mean, cov), det = after, new
            if best is None or det < best[0] * (1 - 1e-9):
                best = det, mean, cov
        _, mean, cov = best
        last = estimate(x[distance(x, mean, cov) <= within], 1)
        far = distance(np.array([v for _, v in members]), *last)
        out |= dict(zip((i for i, _ in members), far.tolist()))
    return out


def attention_score(model, passages):
    """The probability of label 1 for one document's rows, passage by passage."""
    def sigmoid(v):
        return 1 / (1 + math.exp(-v))

    codes, strengths = [], []
    for x in passages:
        x = [(a - c) / s for a, c, s in zip(x, model.centre, model.scale)]
        h = [math.tanh(sum(a * w for a, w in zip(x, column)) + b)
             for column, b in zip(model.encode.T, model.encode_0)]
        gated = [math.tanh(sum(a * w for a, w in zip(h, v))) * sigmoid(sum(a * w for a, w in zip(h, u)))
                 for v, u in zip(model.value.T, model.gate.T)]
        codes.append(h)
        strengths.append(math.exp(sum(a * w for a, w in zip(gated, model.weight))))
    z = [sum(e * h[k] for e, h in zip(strengths, codes)) / sum(strengths) for k in range(len(codes[0]))]
    return sigmoid(max(-30, min(30, sum(a * w for a, w in zip(z, model.out)) + float(model.out_0))))
