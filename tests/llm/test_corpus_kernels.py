"""Numpy kernels against brute force."""

import collections
import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from atelier.llm import chosen_path, decontaminate, html_crf, packing, pii_tagger, suffix_rules, zstd_quality
from atelier.llm.words import shingles, span_hash, texts, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def random_texts(count, seed):
    r = random.Random(seed)
    vocabulary = ["a", "b", "é", "ß#", "the", "of", "|", "x y", " ", "\x1c", "日本"]
    out = [None, "", " \n ", "\n\n", "word", "\n".join(["same line"] * 5), "a " * 3000]
    for _ in range(count):
        out.append("".join(r.choice(vocabulary) + r.choice([" ", " ", "\n", "\t", "  "]) for _ in range(r.randint(0, 60))))
    return out


def brute_profile(t, least):
    t = t or ""
    w = WORD.findall(t)
    counts = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    windows = set()
    for i in range(len(w) - 2):
        if counts[w[i], w[i + 1], w[i + 2]] > 1:
            windows |= {i, i + 1, i + 2}
    seen, repeats = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    places = collections.defaultdict(list)
    for i in range(len(w) - least + 1):
        places[tuple(w[i : i + least])].append(i)
    covered = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(least)}
    longest = 0
    for p in places.values():
        for i, j in itertools.combinations(p, 2) if len(p) < 40 else zip(p, p[1:], strict=False):
            k = least
            while j + k < len(w) and w[i + k] == w[j + k]:
                k += 1
            longest = max(longest, k)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), repeats, len(windows), len(covered), longest


@pytest.mark.parametrize("least", [4, 8])
def test_suffix_profile(least):
    rows = random_texts(150, 1)
    p = suffix_rules.profile(pa.array(rows, pa.string()), least)
    keys = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")
    for i, t in enumerate(rows):
        assert tuple(int(p[k][i]) for k in keys) == brute_profile(t, least), (i, t)


def test_maximal_repeats():
    assert sorted(suffix_rules.maximal_repeats("a b c d a b c x a b", 2)) == [(2, [0, 4, 8]), (2, [1, 5]), (3, [0, 4])]
    assert suffix_rules.maximal_repeats("", 2) == []


def test_words_do_not_cross_texts():
    w = words(texts(pa.array(["ab", "cd ef", None, "", "g"])))
    assert (w.last - w.first).tolist() == [1, 2, 0, 0, 1]
    t = texts(pa.array(["abc", "xabc"]))
    prefix = __import__("atelier.llm.words", fromlist=["prefix_hash"]).prefix_hash(t)
    assert span_hash(prefix, np.array([0]), np.array([3])) == span_hash(prefix, np.array([4]), np.array([7]))


def test_built_collisions_are_told_apart():
    """Thue-Morse strings collide under any polynomial modulo 2^64."""
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    t = texts(pa.array([a, b]))
    prefix = __import__("atelier.llm.words", fromlist=["prefix_hash"]).prefix_hash(t)
    raw = span_hash(prefix, t.cut[:-1], t.cut[1:])
    assert raw[0] == raw[1] and len(set(words(t).hash.tolist())) == 2
    p = suffix_rules.profile(pa.array([f"{a}\n{b}\n{a}", f"{a} {b} {a} {b} {b} {a}"]))
    assert p["n_dup_lines"].tolist() == [1, 0] and p["n_repeat_words"].tolist() == [0, 0]
    value, row = shingles(pa.array([a, b]), 5)
    assert len(set(value.tolist())) == 2


def test_shingles():
    value, row = shingles(pa.array(["A b c d e f", "a B c d e f", "one two", "ONE two", "", None, "a a a a a a a"]), 5)
    sets = [set(value[row == i].tolist()) for i in range(7)]
    assert [len(s) for s in sets] == [2, 2, 1, 1, 0, 0, 1]
    assert sets[0] == sets[1] and sets[2] == sets[3]


def test_token_sketch_estimates_similarity():
    r = random.Random(2)
    base = [f"w{r.randrange(10**6)}" for _ in range(300)]
    near = list(base)
    for _ in range(5):
        near[r.randrange(300)] = "new"
    value, row = shingles(pa.array([" ".join(base), " ".join(near)]), 5)
    a, b = (set(value[row == i].tolist()) for i in (0, 1))
    sketch = chosen_path.tokens(value, np.searchsorted(row, [0, 1]))
    assert abs((sketch[0] == sketch[1]).mean() - len(a & b) / len(a | b)) < 0.2
    assert chosen_path.runs_for(0.99, 1) <= chosen_path.runs_for(0.99, 3) <= chosen_path.runs_for(0.999, 3)


@pytest.mark.parametrize("dense", [0, 3, 48])
def test_common_counts(monkeypatch, dense):
    monkeypatch.setattr(chosen_path, "DENSE", dense)
    r = random.Random(11)
    for n, terms in ((1, 4), (7, 9), (40, 300), (90, 12)):
        sets = [{r.randrange(terms) for _ in range(r.randint(0, terms))} for _ in range(n)]
        term, row = np.array([t for s in sets for t in s], np.int64), np.array([i for i, s in enumerate(sets) for _ in s], np.int64)
        got = chosen_path.common_counts(term, row, n)
        assert all(got[i, j] == len(sets[i] & sets[j]) for i, j in itertools.permutations(range(n), 2))


def test_bucket_bounds_are_optimal():
    r = random.Random(3)
    pad = lambda h, b: sum(n * (min(x for x in b if x >= length) - length) for length, n in h.items())
    for _ in range(200):
        h = {r.randint(1, 40): r.randint(1, 9) for _ in range(r.randint(1, 8))}
        k, lengths = r.randint(1, 5), sorted(h)
        bounds = packing.optimal_bounds(h, k)
        best = min(pad(h, (*c, lengths[-1])) for n in range(min(k, len(lengths))) for c in itertools.combinations(lengths[:-1], n))
        assert len(bounds) <= k and bounds[-1] == lengths[-1] and pad(h, bounds) == best
    assert packing.optimal_bounds({}, 4) == []


def test_tokens_of_cut_runs(monkeypatch):
    """Runs cut out before the pattern give the tokens of the pattern alone."""
    import base64

    import tiktoken

    with open(packing.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(t): int(k) for t, k in map(bytes.split, f)}
    whole = tiktoken.Encoding("whole", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    count = packing.token_counter()
    monkeypatch.setattr(packing, "LONG_RUN", 3)
    monkeypatch.setattr(packing, "_RUN", re.compile(packing._RUN.pattern.replace("{10000,}", "{3,}")))
    assert packing._RUN.pattern.endswith("{3,}")
    r = random.Random(9)
    spaces = " \n\t\r\x0b\x0c\u3000\x85\xa0\x1c\x1f\u200b\u2028"
    for _ in range(6000):
        t = "".join(r.choice(["a", "é", "1", "!", "'s", " the"]) if r.random() < 0.3 else r.choice(spaces) * r.choice([1, 1, 2, 5, 9]) for _ in range(r.randint(0, 14)))
        assert count(t) == len(whole(t)), t


def test_common_subsequence():
    r = random.Random(4)
    for _ in range(200):
        a, b = ([r.randrange(6) for _ in range(r.randint(1, 20))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common_subsequence(decontaminate._bits(a), len(a), b) == table[-1][-1]


def test_range_finder_finds_the_eigenvectors():
    r = np.random.default_rng(5)
    u, _ = np.linalg.qr(r.standard_normal((60, 60)))
    g = (u * (0.6 ** np.arange(60))) @ u.T
    probe = r.standard_normal((60, 20))
    found = decontaminate.eigenvectors(g @ probe, probe, 5)
    assert np.allclose(np.abs((u[:, :5] * found).sum(0)), 1, atol=1e-2)


def test_gram_part_is_the_product():
    r = np.random.default_rng(6)
    row, term = np.sort(r.integers(0, 9, 80)), r.integers(0, 15, 80)
    idf, probe = r.random(15) + 0.5, r.standard_normal((15, 4)).astype(np.float32)
    i, j, w = decontaminate.tf_idf(row, term, idf)
    a = np.zeros((9, 15))
    a[i, j] = w
    assert np.allclose((a**2).sum(1), 1, atol=1e-5)
    assert np.allclose(decontaminate.gram_part(i, j, w, probe), a.T @ (a @ probe), atol=1e-4)
    assert np.allclose(decontaminate.project(i, j, w, probe, 9), a @ probe, atol=1e-5)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(t):
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[ -]", "", m[0])
        if 12 <= len(d) <= 19 and pii_tagger.luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[1], pii_tagger.KINDS.index(s[0])))


def test_base_spans():
    r = random.Random(7)
    for _ in range(4000):
        t = "".join(r.choice("a1@.+- ()25é\n") for _ in range(r.randint(0, 40)))
        assert pii_tagger.base_spans(t) == brute_spans(t), t
    assert pii_tagger.base_spans("4111 1111 1111 1111 +1 (212) 555-0100 a@b.co 10.0.0.255") == brute_spans("4111 1111 1111 1111 +1 (212) 555-0100 a@b.co 10.0.0.255")
    assert pii_tagger.base_spans("a" * 200_000 + "1" * 200_000 + "@") == []


def test_tagger_gradients():
    t = pii_tagger.Tagger(1)
    t.p = {k: v.astype(np.float64) for k, v in t.p.items()}
    rows = pii_tagger.labelled_texts(3, 5)
    x = np.stack([np.pad(pii_tagger.codes(s)[:40], (0, max(0, 40 - len(s)))) for s, _ in rows])
    y = np.stack([np.pad(pii_tagger.label_codes(s, p)[:40], (0, max(0, 40 - len(s)))) for s, p in rows])

    def loss():
        scores, moves, total = t.scores(x).astype(float), t.p["moves"] + pii_tagger._MOVES, 0.0
        for s, labels in zip(scores, y, strict=True):
            f = s[0] + pii_tagger._START
            for k in range(1, 40):
                z = f[:, None] + moves
                f = z.max(0) + np.log(np.exp(z - z.max(0)).sum(0)) + s[k]
            path = s[np.arange(40), labels].sum() + moves[labels[:-1], labels[1:]].sum()
            total += f.max() + np.log(np.exp(f - f.max()).sum()) - path
        return total / len(x)

    g = t.gradients(x, y)
    for name, at in (("out", (3, 1)), ("wf", (2, 5)), ("wb", (15, 30)), ("moves", (0, 1)), ("bf", (4,)), ("embed", (1, 3))):
        held = t.p[name][at]
        t.p[name][at] = held + 1e-4
        up = loss()
        t.p[name][at] = held - 1e-4
        down = loss()
        t.p[name][at] = held
        assert abs((up - down) / 2e-4 - g[name][at]) < 1e-3 * max(1, abs(g[name][at])), name


@pytest.mark.parametrize(
    "value, kind",
    [
        ("jane (at) example (dot) com", "email"),
        ("jane.doe [AT] mail.example [dot] org", "email"),
        ("jane＠example.com", "email"),
        ("ｊａｎｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email"),
        ("١٩٠.١٣٧.١٠.٩", "ip"),
        ("+１ (８２６) ５５５-４０８１", "phone"),
        ("४१११११११११११११११", "card"),
        ("john.doe at example dot com", "email"),
        ("john @ example.com", "email"),
        ("10 . 0 . 0 . 7", "ip"),
        ("10[.]20[.]30[.]40", "ip"),
    ],
)
def test_forms_that_the_base_rules_do_not_read(value, kind):
    text = f"please write to {value} before noon"
    base, both = pii_tagger.all_spans([text, "meet (at) noon, then a point (dot) here"], pii_tagger.trained())
    assert base == [[], []] and both == [[(kind, 16, 16 + len(value))], []]


def test_folding_keeps_places():
    text = "a  (at) b٣ { dot }c" + " " * 100_000 + "("
    new, places = pii_tagger.folded(text)
    assert new == "a@b3.c" + " " * 100_000 + "(" and [text[a:b] for a, b in places[:6]] == ["a", "  (at) ", "b", "٣", " { dot }", "c"]
    assert len(places) == len(new) and places[-1][1] == len(text) and pii_tagger.folded("x１") == ("x1", [(0, 1), (1, 2)])


def unlike_texts(count, seed):
    """Texts made in another way than those of the training: English words, values by other recipes, other scripts."""
    r = random.Random(seed)
    vocabulary = "a meeting at the old mill was moved to Friday because two of the guests could not come dot by dot they drew a map of it at home and sent one copy".split()
    scripts = ["0123456789", "٠١٢٣٤٥٦٧٨٩", "०१२३४५६७८९", "０１２３４５６７８９"]
    number = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    name = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 9)))

    def card():
        body = r.choice("3456") + number(14)
        whole = next(body + c for c in "0123456789" if pii_tagger.luhn(body + c))
        return whole if r.random() < 0.5 else " ".join(whole[k : k + 4] for k in range(0, 16, 4))

    def email():
        at, dot = r.choice([("@", "."), ("@", "."), ("＠", "."), (" [at] ", " [dot] "), ("(at)", "."), (" at ", " dot ")])
        return f"{name()}{at}{name()}{dot}{r.choice(['com', 'net', 'org'])}"

    makers = {"email": email, "ip": lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)), "card": card, "phone": lambda: f"+{r.randint(1, 99)} {number(3)} {number(3)} {number(4)}"}
    out = []
    for _ in range(count):
        text, spans = " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 120))) + " ", []
        for _ in range(r.choice([0, 1, 1, 2])):
            kind = r.choice(pii_tagger.KINDS)
            value = makers[kind]()
            if kind != "email":
                value = value.translate(dict(zip(map(ord, scripts[0]), r.choice(scripts), strict=True)))
            spans.append((kind, len(text), len(text) + len(value)))
            text += value + r.choice([" ", ", ", "; "]) + " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 120))) + " "
        out.append((text + r.choice(["", "12 of 30 pages, 4.5 in all"]), spans))
    return out


def test_windows_without_hints_hold_nothing():
    """Windows that are not run would add no span: against all windows, on unlike texts and a table."""
    import pyarrow.parquet as pq

    tagger = pii_tagger.trained()
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist()
    made = unlike_texts(400, 5)
    rows = [t for t, _ in made] + [t or "" for t in table] + ["", "7", "x" * 5000 + " a@b.co", "ünï " * 3000]
    values = lambda found: [[v for s in spans for v in pii_tagger.checked(t, *s)] for t, spans in zip(rows, found, strict=True)]
    assert values(pii_tagger.tagged_spans(rows, tagger)) == values(pii_tagger.tagged_spans(rows, tagger, whole=True))
    _, both = pii_tagger.all_spans([t for t, _ in made], tagger)
    want = sum(len(s) for _, s in made)
    right = sum(len(set(a) & set(b)) for a, (_, b) in zip(both, made, strict=True))
    assert right / want > 0.85 and right / sum(map(len, both)) > 0.9, (right, want, sum(map(len, both)))


def test_tagger_learns_and_windows_agree():
    tagger = pii_tagger.trained()
    held_out = pii_tagger.labelled_texts(150, 77)
    found = pii_tagger.tagged_spans([t for t, _ in held_out], tagger)
    right = sum(len(set(a) & set(b)) for a, (_, b) in zip(found, held_out, strict=True))
    assert right / sum(map(len, found)) > 0.9 and right / sum(len(b) for _, b in held_out) > 0.9
    pad = "lorem ipsum dolor sit amet " * 3
    for shift in range(0, 96, 7):  # wherever windows cut, the span is whole
        text = "x" * shift + " " + pad + "mail john.doe7@example.com now " + pad
        spans = pii_tagger.tagged_spans([text], tagger)[0]
        assert ("email", text.index("john"), text.index(" now")) in spans
    base, both = pii_tagger.all_spans(["call +1 (826) 555-4081 190.137.10.9 now", "", "no data at all"], tagger)
    assert base[0] == [("ip", 23, 35)] or ("ip", 23, 35) in both[0]
    assert both[1] == both[2] == []


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(8)
    moves = r.standard_normal((pii_tagger.LABELS, pii_tagger.LABELS)) + pii_tagger._MOVES
    scores = [r.standard_normal((n, pii_tagger.LABELS)).astype(np.float32) for n in (1, 4, 3)]
    value = lambda s, p: s[np.arange(len(p)), p].sum() + pii_tagger._START[p[0]] + sum(moves[a, b] for a, b in itertools.pairwise(p))
    for s, path in zip(scores, pii_tagger.viterbi(scores, moves), strict=True):
        best = max(itertools.product(range(pii_tagger.LABELS), repeat=len(s)), key=lambda p: value(s, p)) if len(s) < 5 else None
        assert np.isclose(value(s, path), value(s, best))


@pytest.mark.parametrize("steps", [256, 257, 511, 512, 3000])
def test_chunks_give_the_same_path(steps):
    r = np.random.default_rng(steps)
    for spread in (0.3, 3.0):
        moves = r.standard_normal((pii_tagger.LABELS, pii_tagger.LABELS)) + pii_tagger._MOVES
        score = (r.standard_normal((steps, pii_tagger.LABELS)) * spread).astype(np.float32)
        assert (pii_tagger.long_viterbi(score, moves) == pii_tagger.viterbi([score], moves)[0]).all()


def test_a_long_text_of_digits():
    text, tagger = "7 1 " * 100_000 + "a@b.co", pii_tagger.trained()
    began = time.process_time()
    base, both = pii_tagger.all_spans([text], tagger)
    assert base == both == [[("email", 400_000, 400_006)]] and time.process_time() - began < 40


def test_leaf_blocks():
    page = """<html><head><title>T &amp; t</title><script>var a="<p>no</p>";</script></head><body><!-- <p>no</p> --><nav><ul><li><a href="/x">One<li><a href="/y">Two</a></ul></nav>
    <article><h1>Head</h1><p>a <b>b<br>c</b>  &eacute;<p title="x > y">d<div class="ad">buy</div></article><footer>&copy; f"""
    blocks = html_crf.leaf_blocks(page)
    assert [b[0] for b in blocks] == ["T & t", "One", "Two", "Head", "a b c é", "d", "buy", "© f"]
    assert "tag:nav" in blocks[1][1] and blocks[2][3] == 1.0 and "tag:nav" not in blocks[3][1]
    assert {"class:ad", "tag:article"} <= blocks[6][1]
    assert html_crf.leaf_blocks("") == [] and html_crf.leaf_blocks("<p></p> <br>") == []


@pytest.mark.parametrize(
    "page, want",
    [
        ('<nav><svg-icon name="m"></svg-icon></nav><article><p>whole article</p></article>', ["whole article"]),
        ("<template-card><p>a</p></template-card><object-view>b</object-view><SVG.x>c<p>d</p>", ["a", "bc", "d"]),
        ("<p>a <svg/> b</p><p>c</p>", ["a b", "c"]),
        ('<p>a <svg class="x=" hidden/> b</p><p>c</p>', ["a b", "c"]),
        ("<p>a <svg class=x/><text>drawn</text></svg> b</p>", ["a b"]),  # this slash is part of the value
        ("<p>a <math/> b</p><p>c</p>", ["a b", "c"]),
        ("<p>if <math><mi>x</mi><mo>=</mo><mn>1</mn></math> then</p><p>c</p>", ["if x=1 then", "c"]),
        ("a<script/>x<b>y</b></SCRIPT >b<Svg\n><text>x</text></svg>c<style>p{}</style-x></style>d<iframe>never closed <p>e", ["abcd"]),
    ],
)
def test_raw_elements_end_where_they_should(page, want):
    assert [b[0] for b in html_crf.leaf_blocks(page)] == want


@pytest.mark.parametrize("plain, unmarked, most", [(0.0, 0.0, 0.01), (0.0, 1.0, 0.03), (1.0, 0.0, 0.02)])
def test_field_decodes_held_out_pages(plain, unmarked, most):
    """Articles with marks, without any on otherwise marked pages, and on pages without marks or with misleading ones."""
    field = html_crf.trained()
    pages = html_crf.labelled_pages(200, 99, plain, unmarked)
    wrong = sum(sum(a != b for a, b in zip(field.decode(html_crf.leaf_blocks(p)), y, strict=True)) for p, y in pages)
    assert wrong / sum(len(y) for _, y in pages) < most


@pytest.mark.parametrize(
    "page, want",
    [
        ("<div><h1>A quiet river</h1><p>The river rises in the hills.</p><p>It ends in a lake.</p></div>", "A quiet river\nThe river rises in the hills.\nIt ends in a lake."),
        ("only one line of text, without any tag", "only one line of text, without any tag"),
        (
            "<html><head><title>Rivers</title></head><body><div><a href=/>Home</a> <a href=/n>News</a></div><div><h1>A quiet river</h1><p>The river rises in the hills, and it runs for many miles.</p>"
            "<p>It ends in a lake that freezes over in every winter.</p></div><div>&copy; 2020 Rivers</div></body></html>",
            "A quiet river\nThe river rises in the hills, and it runs for many miles.\nIt ends in a lake that freezes over in every winter.",
        ),
        (
            "<html><body><table><tr><td><a href=a>One</a><br><a href=b>Two</a></td><td><h2>A quiet river</h2><p>The river rises in the hills, and it runs for many miles.</p>"
            "<p>It ends in a lake that freezes over in every winter.</p></td></tr></table></body></html>",
            "A quiet river\nThe river rises in the hills, and it runs for many miles.\nIt ends in a lake that freezes over in every winter.",
        ),
        (
            '<html><body class="has-sidebar"><nav><a href=/>Home</a></nav><div class="menu-open"><h1>A quiet river</h1><p>The river rises in the hills, and it runs for many miles.</p>'
            '<p>It ends in a lake that freezes over in every winter.</p></div><aside><p>Buy a boat now!</p></aside><footer>&copy; Rivers</footer></body></html>',
            "A quiet river\nThe river rises in the hills, and it runs for many miles.\nIt ends in a lake that freezes over in every winter.",
        ),
        ("<nav><a href=/>Home</a></nav><article><p>Let <math><mi>x</mi></math> be a number, <object>drawn</object> here.</p></article>", "Let x be a number, drawn here."),
    ],
)
def test_pages_without_telling_marks(page, want):
    assert html_crf.main_text(page, html_crf.trained()) == want


def test_reading_is_linear_and_bounded():
    """Stray, unclosed and deep tags, and attributes that never repeat."""
    pages = ["<b>" * 50_000 + "</i>" * 50_000, "<b>x<p>y</p>" * 50_000, "<div>" * 100_000 + "x", "<i>" + "<div>" * 50_000 + "</i>" * 50_000, "<p>x" * 100_000, "<table><td>" * 50_000 + "</tr>" * 50_000, '<a "' * 50_000]
    for page in pages:
        began = time.process_time()
        html_crf.leaf_blocks(page)
        assert time.process_time() - began < 3, page[:20]  # a tenth of it is usual; the square of the tags took minutes
    for part in range(20):
        html_crf.leaf_blocks("".join(f'<i class="c{part}x{k}">x</i>' for k in range(5_000)))
    html_crf.leaf_blocks(f'<i class="{"x" * 1_000_000}">x</i>')
    assert html_crf._known_marks.cache_info().currsize <= 8192


def test_field_viterbi():
    field = html_crf.Field(["bias", "tag:p"], np.array([-0.2, 0.7]), np.random.default_rng(1).standard_normal((2, 2, 2)))
    field.weight |= {"words:1": 0.3, "ends": -0.9}
    blocks = [("w.", frozenset(), 1, 0.0, 1), ("w", frozenset(["tag:p"]), 1, 0.0, 1), ("w w.", frozenset(["tag:p"]), 2, 0.0, 2), ("w", frozenset(), 2, 0.0, 2)]
    own = html_crf.page_features(blocks)
    field.weight |= {"bare/in:none": 0.4, "bare/place:last": -0.3}

    def value(labels):
        total = 0.0
        for k, (_, f, s, *_) in enumerate(blocks):
            if labels[k]:
                total += sum(field.weight.get(x, 0) for x in (*f, *own[k])) + field.weight["bias"]
            if k:
                total += field.moves[s == blocks[k - 1][2]][labels[k - 1]][labels[k]]
        return total

    best = max(itertools.product((0, 1), repeat=4), key=value)
    assert [int(x) for x in field.decode(blocks)] == list(best)


def test_monotone_fit():
    r = np.random.default_rng(9)
    x = r.random(400)
    y = (r.random(400) < x).astype(float)
    at, p = zstd_quality.monotone_fit(x, y)
    assert at == sorted(at) and all(a <= b + 0.05 for a, b in itertools.pairwise(p)) and all(0 < v < 1 for v in p)
    assert abs(np.interp(0.5, at, p) - 0.5) < 0.15
