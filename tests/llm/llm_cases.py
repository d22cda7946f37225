"""Plain-Python versions of the corpus operators, and awkward rows, for the tests."""

import re
from collections import defaultdict
from functools import reduce

import numpy as np
import xxhash

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, first_id=0, lang="en", source="s"):
    rows = [(first_id + i, t, lang, source, None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def clashing(df, *names):
    """The frame with extra columns of the names that operators use or return."""
    from pyspark.sql import functions as F
    for n in names:
        df = df.withColumn(n, F.lit("extra"))
    return df


def components(nodes, links):
    low = {n: n for n in nodes}

    def find(x):
        while low[x] != x:
            low[x] = low[low[x]]
            x = low[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash(text, words=3, seed=42):
    toks = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not toks:
        return 0
    runs = [b" ".join(toks[i:i + words]) for i in range(len(toks) - words + 1)] or [b" ".join(toks)]
    h = [xxhash.xxh64_intdigest(r, seed) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_groups(rows, max_bits=2):
    """{doc_id: component} of (doc_id, text) rows."""
    fp = {}
    for i, t in rows:
        fp.setdefault(simhash(t), []).append(i)
    fps = sorted(fp)
    links = [(fp[a][0], fp[b][0]) for n, a in enumerate(fps) for b in fps[n + 1:] if (a ^ b).bit_count() <= max_bits]
    links += [(ids[0], i) for ids in fp.values() for i in ids]
    return components([i for i, _ in rows], links)


ALONE = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]


def blank_words(text):
    """``(word, white space behind it)`` pairs of a text, without its leading white space."""
    out = []
    for run, gap in re.findall(r"([^\x20\x09-\x0D]+)([\x20\x09-\x0D]*)", text):
        word = ""
        for ch in run:
            if any(a <= ord(ch) <= z for a, z in ALONE):
                out += [(word, "")] if word else []
                out.append((ch, ""))
                word = ""
            else:
                word += ch
        out += [(word, "")] if word else []
        out[-1] = (out[-1][0], gap)
    return out


def divided(words, long_sentence=12, reach=3):
    """Sentences as lists of word numbers, long ones divided."""
    import hashlib
    sents, now = [], []
    for n, (w, gap) in enumerate(words):
        now.append(n)
        if w[-1] in ".!?。！？।" or "\n" in gap:
            sents.append(now)
            now = []
    if now:
        sents.append(now)
    out = []
    for s in sents:
        if len(s) <= long_sentence:
            out.append(s)
            continue
        code = [int(hashlib.md5(words[n][0].encode().lower()).hexdigest()[:8], 16) for n in s]
        part = []
        for k, n in enumerate(s):
            part.append(n)
            low = all(code[k] < c for c in code[max(0, k - reach):k]) and all(code[k] <= c for c in code[k + 1:k + 1 + reach])
            if low or k == len(s) - 1:
                out += [part[i:i + long_sentence] for i in range(0, len(part), long_sentence)]
                part = []
    return out


def span_clean(rows, span=3, min_words=30):
    """{doc_id: (text, sentences, removed)} of (doc_id, text) rows with distinct ids."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        words = blank_words(t or "")
        sents, lost = divided(words), set()
        for a in range(len(sents)):
            for k in range(a, len(sents)):
                run = [n for s in sents[a:k + 1] for n in s]
                if k - a + 1 >= span and len(run) >= min_words:
                    key = tuple(words[n][0].encode().lower() for n in run)
                    if key in seen:
                        lost.update(range(a, k + 1))
                    seen.add(key)
                    break
        lead = re.match(r"[\x20\x09-\x0D]*", t or "").group()
        kept = lead + "".join("".join(words[n]) for m, s in enumerate(sents) if m not in lost for n in s)
        out[i] = (None if t is None else kept, len(sents), len(lost))
    return out


def plain_words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())


def least_edits(item, text):
    """Least word edits between the item and any run of the text's words."""
    row = np.zeros(len(text) + 1, dtype=int)
    codes = np.array([hash(w) for w in text] or [0])[:len(text)]
    for i, w in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        sub = row[:-1] + (codes != hash(w))
        up = row[1:] + 1
        for_all = np.minimum(sub, up)
        new[1:] = for_all
        steps = np.arange(len(new))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def held_items(rows, items, similarity=0.8):
    """{(doc_id, item_id): edits}."""
    out = {}
    for i, t in rows:
        text = plain_words(t)
        for k, x in items:
            item = plain_words(x)
            if item and text:
                d = int(len(item) * (1 - similarity) + 1e-9)
                e = least_edits(item, text)
                if e <= d:
                    out[i, k] = e
    return out


def word_size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2.0):
    """{source: target} by giving out the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, done = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in done]
        left = budget - sum(done.values())
        total = sum(weight[s] for s in rest)
        new = {s: epochs * sizes[s] for s in rest if left * weight[s] / total >= epochs * sizes[s]}
        if not new:
            return {**done, **{s: left * weight[s] / total for s in rest}}
        done |= new
        if len(done) == len(order):
            return done


def mixed(rows, seed=17):
    """{doc_id: taken} of (doc_id, text, source) rows with distinct ids."""
    import hashlib
    size = {i: word_size(t) for i, t, _ in rows}
    by = defaultdict(list)
    for i, _, s in rows:
        by[s].append(i)
    total = {s: sum(size[i] for i in ids) for s, ids in by.items()}
    goal, out = targets(total), {}
    for s, ids in by.items():
        passes = int(goal[s] // total[s]) if total[s] else 0
        left = int(goal[s]) - passes * total[s]
        for i in sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i)):
            part = min(size[i], max(0, left))
            left -= part
            out[i] = passes * size[i] + part
    return out


def union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)
