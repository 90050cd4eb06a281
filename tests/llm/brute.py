"""Plain Python versions of the operators, and a small table with every awkward case."""

import hashlib
import re

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

WORDS = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi omi pi rho sigma tau ups".split()


def sentence(n, seed):
    """A fixed pseudo-random run of n words."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 50))
    return out


def awkward():
    """(doc_id, text) rows: nulls, empties, ties, repeated rows, near copies, odd characters, a long text."""
    base = sentence(120, 1)
    near = base.copy()
    near[60] = "changed"
    far = base.copy()
    for i in range(0, 120, 9):
        far[i] = "other"
    rows = [
        (5, " ".join(base)), (3, " ".join(base)), (9, " ".join(near)), (11, " ".join(far)), (5, " ".join(base)),
        (20, None), (21, ""), (22, "  \n\t "), (23, "one two"), (24, "ONE two"), (25, "one\x0btwo"), (None, "a b c d e f"),
        (None, None), (30, "é à ü " * 7), (31, "É À Ü " * 7), (40, " ".join(sentence(40000, 2))),
        (41, " ".join(sentence(30, 3) + base[10:75] + sentence(30, 4))), (42, " word word\x01 x \x00y"), (43, "𝒳𝒴 " * 30 + "ſecret Ktoken"),
    ]
    return rows


def words_by_space(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))


def shingles(text):
    w = words_by_space(text)
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def near_components(rows, percent=85):
    """{doc_id: (n_shingles, component)} of rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    where = {}
    for i in ids:
        for s in sets[i]:
            where.setdefault(s, []).append(i)
    seen = set()
    for group in where.values():
        for x in range(len(group)):
            for y in range(x + 1, len(group)):
                seen.add((group[x], group[y]))
    for a, b in seen:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * len(sets[a] | sets[b]):
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


def words_by_letter(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def contaminated(rows, items, window=10):
    """[(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)] in the order of rows."""
    grams = {}
    for item, text in items:
        w = words_by_letter(text)
        if item is not None and w:
            size = min(len(w), window)
            for i in range(len(w) - size + 1):
                grams.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in rows:
        w, hit, found = words_by_letter(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (owners := grams.get(tuple(w[i : i + size]))) is not None:
                    hit.update(range(i, i + size))
                    found |= owners
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def secret_spans(text):
    """Base spans by plain regular expressions."""
    text = text or ""
    out = []
    pattern = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, m.end()) for m in re.finditer(pattern, text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def secrets(text):
    """(n_assign, n_access, n_hex, base_sha256)"""
    spans = secret_spans(text)
    joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
    return (*(sum(k == n for _, k, _ in spans) for n in range(3)), hashlib.sha256(joined.encode()).hexdigest())


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def personal(text):
    """(n_email, n_ip, n_card, n_phone, base_sha256)"""
    text = text or ""
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    found = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    ]
    counts, parts = [], []
    for kind, pattern, valid in found:
        spans = [m.span() for m in re.finditer(pattern, text) if valid(m[0])]
        counts.append(len(spans))
        parts += [f"{kind}:{a}:{b}" for a, b in spans]
    return (*counts, hashlib.sha256(",".join(parts).encode()).hexdigest())


def edited_texts(rows):
    """{doc_id: (n_chars, edited text, next text)} for rows with distinct ids."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(rows):
        t, n = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        out[i] = (len(t), t[: len(t) - half] + n[:half], n)
    return out


def chunks(text, gear, least, normal, most, hard, easy):
    """Content-defined chunks, byte by byte."""
    data, out = text.encode(), []
    start = 0
    while len(data) - start > least:
        cut = min(len(data), start + most)
        for end in range(start + least, cut + 1):
            h = 0
            for b in data[end - 16 : end]:
                h = (2 * h + int(gear[b])) % 65536
            bits = hard if end <= start + normal else easy
            # at the normal size both rules apply: the easy one includes the hard one
            if h >> (16 - (easy if end == start + normal else bits)) == 0:
                cut = end
                break
        out.append(data[start:cut])
        start = cut
    return out + [data[start:]] * (start < len(data))


def host_path(url):
    """Host and path by the rule of the query."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return host.translate(ASCII_LOWER), re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]


def rule_of(host, path, rules):
    """The longest fitting rule and its verdict."""
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)
