"""The contract of each query, worked out row by row in plain Python on a few hundred texts."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import public_tokenizers
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def bpe(name):
    import base64

    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("brute", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def byte_bpe(docs):
    coder = bpe("byte_bpe_multi_50k.tiktoken")
    for doc_id, text in docs:
        ids = coder.encode_ordinary(text or "")
        yield (doc_id, len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)),
               sha((text or "").encode()))


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def near_duplicates(docs):
    """Ids must be unique."""
    sets = {d: shingles(t) for d, t in docs}
    label = {d: d for d in sets}

    def top(d):
        while label[d] != d:
            d = label[d]
        return d

    holders = collections.defaultdict(list)
    for d, own in sets.items():
        for s in own:
            holders[s].append(d)
    common = collections.Counter()
    for group in holders.values():
        for i, a in enumerate(group):
            for b in group[i + 1:]:
                common[a, b] += 1
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((top(a), top(b)))
            label[b] = a
    for d in sets:
        yield (d, len(sets[d]), top(d), top(d) == d)


def token_files(docs):
    """Ids must be unique."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    for doc_id, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        yield (doc_id, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        start += len(ids)


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"),
         ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host):])[0]


def fixed_rules(pages):
    """``page_id, host, path, rule, verdict``; the verdict is None where no rule fits."""
    for page_id, url in pages:
        host, path = url_parts(url)
        fit = [(h + p, v) for v, h, p in RULES
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fit, key=lambda f: len(f[0]), default=(None, None))
        yield (page_id, host, path, rule, verdict)


def decontamination(docs, items):
    windows = collections.defaultdict(set)
    for item_id, text in items:
        words = ITEM_WORD.findall((text or "").translate(LOWER))
        for i in range(max(1, len(words) - 9) if words and item_id is not None else 0):
            windows[tuple(words[i:i + 10])].add(str(item_id))
    sizes = {len(w) for w in windows}
    for doc_id, text in docs:
        words = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                own = windows.get(tuple(words[i:i + size]))
                if own:
                    hit.update(range(i, i + size))
                    found |= own
        yield (doc_id, len(words), len(hit), len(found), sha(",".join(sorted(found)).encode()),
               bool(hit))


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        yield ("email", m.start(), m.end())
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            yield ("ip", m.start(), m.end())
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield ("card", m.start(), m.end())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            yield ("phone", m.start(), m.end())


def private_data(docs):
    for doc_id, text in docs:
        spans = list(base_spans(text))
        kinds = collections.Counter(s[0] for s in spans)
        yield (doc_id, *[kinds[k] for k in ("email", "ip", "card", "phone")],
               sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()))


def quality(docs):
    for doc_id, text in docs:
        text = text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        often = collections.Counter(windows)
        covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
        yield (doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
               sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
               len(words) < 50 or 100 * len(covered) > 50 * len(words))


def repeated_substrings(docs, length=35):
    split = [WORD.findall(t or "") for _, t in docs]
    places = collections.Counter(
        tuple(w[i:i + length]) for w in split for i in range(len(w) - length + 1))
    for (doc_id, _), words in zip(docs, split, strict=True):
        gone = set()
        for i in range(len(words) - length + 1):
            if places[tuple(words[i:i + length])] > 1:
                gone.update(range(i, i + length))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        yield (doc_id, len(words), len(gone), sha(kept.encode()))


def section_counts(docs):
    """Lines of each text; a token counts in the line of its first character."""
    coder = bpe("byte_bpe_50k.tiktoken")
    for doc_id, text in docs:
        data = (text or "").encode()
        ids = coder.encode_ordinary(text or "")
        owners, at = collections.Counter(), 0
        for i in ids:
            owners[data[:at].count(b"\n")] += 1
            at += len(coder.decode_single_token_bytes(i))
        lines = (text or "").split("\n")
        if not lines[-1]:
            lines.pop()
        if not lines:
            yield (doc_id, None, 0, 0, 0, 0)
        begin = 0
        for i, line in enumerate(lines):
            end = min(begin + len(line) + 1, len(text))
            yield (doc_id, f"line {i}", begin, end, owners[i], len(ids))
            begin = end


def sentence_pieces(docs):
    model = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for doc_id, text in docs:
        ids = model.encode(text or "", add_bos=True, add_eos=True)
        yield (doc_id, len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)),
               sha(model.decode(ids).encode()))


def byte_letters():
    """How byte-level tokenizers spell bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def alignment(docs):
    """One pass over each text's tokens for the links, a second one for the counts."""
    a_coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_coder.encode_special_tokens = True
    b_coder = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = byte_letters()

    def b_bytes(i):
        if b_coder.is_byte(i):
            return bytes([int(b_coder.id_to_piece(i)[3:5], 16)])
        return b_coder.id_to_piece(i).replace("\u2581", " ").encode()

    aligned, counts = [], collections.Counter()
    for doc_id, text in docs:
        a = a_coder.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_coder.encode(text) if text else []
        a_spans, b_spans = [], []
        for spans, parts in ((a_spans, [bytes(letters[c] for c in a_coder.id_to_token(i))
                                        for i in a]), (b_spans, [b_bytes(i) for i in b])):
            at = 0
            for part in parts:
                spans.append((at, at + len(part)))
                at += len(part)
            if b"".join(parts) != (" " + text).encode() if text else parts:
                a = b = []
        links, names = [], []
        if a:
            cuts = sorted({e for _, e in a_spans} & {e for _, e in b_spans})
            i = j = 0
            for cut in cuts:
                i0, j0 = i, j
                while i < len(a) and a_spans[i][1] <= cut:
                    i += 1
                while j < len(b) and b_spans[j][1] <= cut:
                    j += 1
                names.append(",".join(map(str, a[i0:i])) + "|" + ",".join(map(str, b[j0:j])))
                links += [(a[x], b[y]) for x in range(i0, i) for y in range(j0, j)
                          if a_spans[x][0] < b_spans[y][1] and b_spans[y][0] < a_spans[x][1]]
        counts.update(links)
        aligned.append((doc_id, len(a), len(b), links, names))
    top = collections.Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    for doc_id, n_a, n_b, links, names in aligned:
        yield (doc_id, n_a, n_b, len(names), len(links),
               sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links),
               sha(";".join(names).encode()) if names else "")
