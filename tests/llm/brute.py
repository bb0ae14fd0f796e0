"""Plain restatements of the operators, one text at a time, to hold the Spark results against."""

import hashlib
import math
import re
import zlib


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def joined(spans, kinds):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted((a, kinds.index(k), k, b) for k, a, b in spans))


def best_window(candidate, width=20):
    def entropy(part):
        return -sum(part.count(c) / width * math.log2(part.count(c) / width) for c in set(part))

    return max(entropy(candidate[i:i + width]) for i in range(len(candidate) - width + 1))


def secrets(text):
    text = text or ""
    word = re.compile(
        "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
    base = [("assign", m.start(), m.end()) for m in word.finditer(text) if m[1].isascii() and len(m[2]) >= 6]
    base += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    base += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    allowed = re.compile(r"(?i:example|sample|dummy|placeholder|changeme|redacted)|(.)\1{7}|(?i:0123456789|1234567890|abcdefghij)")
    more = []
    for m in re.finditer("[A-Za-z0-9+/=_-]{20,}", text):
        c, (begin, end) = m[0], m.span()
        if any(a <= begin and end <= b for _, a, b in base):
            continue
        if not (re.search("[0-9]", c) and re.search("[A-Za-z]", c)):
            continue
        if re.search("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$", c):
            continue
        limit = 3.0 if re.fullmatch("[0-9a-fA-F]+", c) else 3.6 if re.fullmatch("[0-9A-Za-z]+", c) else 3.9
        # What lies between base spans, with the 19 characters on either side that a window can share with them.
        at, parts = begin, []
        for a, b in sorted((a, b) for _, a, b in base if a < end and begin < b) + [(end, end)]:
            if at < a:
                parts.append(text[max(at - 19, begin):min(a + 19, end)])
            at = max(at, b)
        left = []
        for part in parts:
            cuts = [x.span() for x in allowed.finditer(part)]
            left += [part[a:b] for a, b in zip([0, *(y for _, y in cuts)], [*(x for x, _ in cuts), len(part)])]
        if any(len(part) >= 20 and best_window(part) >= limit for part in left):
            more.append(("entropy", begin, end))
    kinds = ["assign", "access", "hex", "entropy"]
    return base, joined(base, kinds), joined(base + more, kinds)


def luhn(number):
    digits = [int(c) for c in number][::-1]
    return (sum(digits[0::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def pii_base(text):
    """The base kinds by their patterns as stated, one `finditer` each."""
    text = text or ""
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return spans, joined(spans, ["email", "ip", "card", "phone"])


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def contaminated(text, items):
    """Number of words, hit positions, ids of the items found."""
    words, hit, found = plain_words(text), set(), set()
    for name, item in items:
        own = plain_words(item)
        k = min(10, len(own))
        windows = {tuple(own[i:i + k]) for i in range(len(own) - k + 1)} if own else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i:i + k]) in windows:
                hit.update(range(i, i + k))
                found.add(str(name))
    return len(words), hit, sorted(found)


def passages(rows, length=50):
    """(id, bytes, removed, spans, digest of the rest) by one dictionary of all strings; a null id is larger than any."""
    key = [(float("inf") if i is None else i) for i, _ in rows]
    texts = [(text or "").encode() for _, text in rows]
    least = {}
    for k, text in zip(key, texts):
        for at in range(len(text) - length + 1):
            part = text[at:at + length]
            least[part] = min(least.get(part, k), k)
    out = []
    for (name, _), k, text in zip(rows, key, texts):
        gone = [False] * len(text)
        for at in range(len(text) - length + 1):
            if least[text[at:at + length]] < k:
                gone[at:at + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        rest = bytes(b for b, g in zip(text, gone) if not g)
        out.append((name, len(text), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


_FOLLOWS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})


def cheapest(rows):
    """rows: (initial, gone, truncated). The least (cost, letters) of all edits, from the last row backwards."""
    after = None
    for i in range(len(rows), -1, -1):
        here = [[(0, "")] * (i == len(rows) and state in (0, 3)) for state in range(4)]
        if i < len(rows):
            initial, gone, truncated = rows[i]
            for state in range(4):
                steps = [("D", 2, state)]
                if not gone:
                    for other, to in _FOLLOWS[state].items():
                        if other == initial:
                            steps.append(("K", 5 * truncated, to))
                        elif other != "s":
                            steps.append(("R", 1 + 5 * truncated, to))
                here[state] = [(cost + c, letter + rest) for letter, cost, to in steps for c, rest in after[to]]
        here = [min(found) if found else None for found in here]
        for _ in range(2):  # one and then two rows put in before row i
            put = [min((5 + here[to][0], "I" + here[to][1]) for other, to in _FOLLOWS[state].items() if other != "s" and here[to])
                   if any(here[to] for other, to in _FOLLOWS[state].items() if other != "s") else None for state in range(4)]
            here = [min(x for x in pair if x) if any(pair) else None for pair in zip(here, put)]
        after = [[found] if found else [] for found in here]
    return after[0][0]


def conversation(rows):
    """`rows` (turn, role, text) as they are after the damage, in order: all that is said of a conversation."""
    seen, judged, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        shown = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
        seen.add((role, text))
        judged.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        if fault:
            count[fault] += 1
    turns = [turn for turn, _, _ in rows if turn is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
    cost, letters = cheapest(judged)
    state, lines, left = 0, [], iter(rows)
    for letter in letters:
        _, role, text = (None, "", "") if letter == "I" else next(left)
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if state == 2 else "user"
        state = _FOLLOWS[state][role[:1]]
        lines.append(f"{role}:{text}")
    return gaps, *count.values(), illegal, cost, letters, sha("\n".join(lines))


def damaged(rows):
    """The rows of each conversation after the damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        own += [(turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    for own in out.values():
        own.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), hashlib.sha256(row[2].encode()).digest()))
    return out


def _tree(nodes):
    """The root over `nodes` and each one's siblings, (whether on the left, digest) or None, level by level."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, place in zip(paths, places):
            other = place ^ 1
            path.append((other < place, nodes[other]) if other < len(nodes) else None)
        nodes = [sha("".join(nodes[at:at + 2])) for at in range(0, len(nodes), 2)]
        places = [place // 2 for place in places]
    return nodes[0], paths


def merkle(rows):
    """`rows`: doc_id, source, lang, n_chars, text."""
    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    groups, out = {}, []
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    langs = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    for own in groups.values():
        own.sort(key=lambda row: (row[0] is not None, row[0] or 0, leaf(row)))
    trees = [_tree([leaf(row) for row in groups[lang]]) for lang in langs]
    root, above = _tree([subroot for subroot, _ in trees])
    for lang, (subroot, paths), top in zip(langs, trees, above):
        for row, path in zip(groups[lang], paths):
            steps = path + top
            altered = row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = leaf((*row[:3], row[3] + 1, row[4])) if altered else leaf(row)
            for step in steps:
                folded = sha(folded) if step is None else sha(step[1] + folded if step[0] else folded + step[1])
            proof = sha("".join(step[1] for step in steps if step))
            out.append((row[0], leaf(row), subroot, root, proof, folded, folded == root))
    return out


def kneser_ney(texts, order, letters, begin="\x02", end="\x03"):
    """The log-probability of a word's letters and its end under interpolated Kneser-Ney counts of `texts` (lists of words);
    `letters` are all characters met in any language, both boundary marks and one for those never met."""
    raw = {}
    for word in (w for text in texts for w in text):
        line = begin + word + end
        for n in range(1, order + 1):
            for at in range(len(line) - n + 1):
                if n == 1 and at == 0:
                    continue  # the beginning is never foretold
                gram = line[at:at + n]
                raw[gram] = raw.get(gram, 0) + 1
    before = {}
    for gram in raw:
        before.setdefault(gram[1:], set()).add(gram)
    count = {
        gram: c if len(gram) == order or gram[0] == begin else max(1, len(before.get(gram, ()))) for gram, c in raw.items()
    }
    discount = {}
    for n in range(1, order + 1):
        ones, twos = (sum(c == k and len(gram) == n for gram, c in count.items()) for k in (1, 2))
        discount[n] = min(0.95, max(0.1, ones / (ones + 2 * twos) if ones + twos else 0.5))
    following = {}
    for gram, c in count.items():
        following.setdefault(gram[:-1], []).append(c)
    def probability(context, letter):
        if context and context not in following:
            return probability(context[1:], letter)
        own, d = following[context], discount[len(context) + 1]
        seen = max(count.get(context + letter, 0) - d, 0) / sum(own)
        rest = d * len(own) / sum(own)
        return seen + rest * (probability(context[1:], letter) if context else 1 / letters)

    def word(w):
        line = begin + w + end
        return sum(math.log(probability(line[max(0, at - order + 1):at], line[at])) for at in range(1, len(line)))

    return word
