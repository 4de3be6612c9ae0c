"""The numpy parts against plain Python, without Spark."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from onomata.llm import chat, decontam, jaccard, langid, lines, neighbours, pii, quality, sharding
from onomata.llm.common import text_bytes
from onomata.llm.words import ALNUM, LINED, SPACED, lower_ascii, run_hashes, runs

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t#0Aß", max_size=40)), max_size=6)


def arrow(texts):
    return pa.array(texts, pa.string())


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_and_lines_of_many_texts(texts):
    data, at = text_bytes(arrow(texts))
    for kind, pattern in ((SPACED, r"[^\x20\x09-\x0D]+"), (LINED, r"[^\n]+")):
        starts, ends, owner = runs(data, at, kind)
        got = [[] for _ in texts]
        for a, b, k in zip(starts, ends, owner, strict=True):
            got[k].append(data[a:b].tobytes().decode())
        assert got == [re.findall(pattern, t or "") for t in texts]
    low = lower_ascii(data)
    starts, ends, owner = runs(low, at, ALNUM)
    lowered = [(t or "").translate({c: c + 32 for c in range(65, 91)}) for t in texts]
    want = [w for t in lowered for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)]
    assert [low[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)] == want
    hashes = run_hashes(low, starts, ends)
    for (h, w), (g, v) in itertools.combinations(zip(hashes.tolist(), want, strict=True), 2):
        assert (h == g) == (w == v)


def base_counts_plainly(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    rows = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(rows) - len(set(rows)), len(again)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_base_counts(texts):
    got = quality.base_counts(arrow(texts))
    assert list(zip(*(got[k].tolist() for k in quality.BASE), strict=True)) == [base_counts_plainly(t) for t in texts]


def jaccard_plainly(a, b):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    x, y = shingles(a), shingles(b)
    return len(x), len(x & y)


def test_shingles_overlaps_and_signatures():
    rng = random.Random(3)
    base = [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(120)]
    texts = [None, "", "  \n", "one two", "one two", "two one", " ".join(base)]
    for _ in range(8):
        other = list(base)
        for k in rng.sample(range(len(base)), 5):
            other[k] = rng.choice("xyz")
        texts.append(" ".join(other))
    gram, first = jaccard.shingle_sets(arrow(texts))
    sets = [gram[first[k] : first[k + 1]] for k in range(len(texts))]
    for a, b in itertools.product(range(len(texts)), repeat=2):
        size, shared = jaccard_plainly(texts[a], texts[b])
        assert (len(sets[a]), len(np.intersect1d(sets[a], sets[b]))) == (size, shared)
    got = jaccard.overlaps(sets[3:], step=16)
    assert all(got[a][b] == len(np.intersect1d(x, y)) for a, x in enumerate(sets[3:]) for b, y in enumerate(sets[3:]))
    prints = jaccard.fingerprints(gram, first)
    assert prints[0] == prints[1] == prints[2] and prints[3] == prints[4] != prints[5]
    sig = jaccard.signatures(gram, first)
    for a, b in itertools.combinations(range(6, len(texts)), 2):
        true = got[a - 3][b - 3] / (len(sets[a]) + len(sets[b]) - got[a - 3][b - 3])
        assert abs((sig[a] == sig[b]).mean() - true) < 0.25


def test_connect_reaches_every_member_of_a_chain():
    n = 30
    root = jaccard._connect(lambda k, rest: np.abs(rest - k) == 1, n)
    assert set(root.tolist()) == {0}
    assert jaccard._connect(lambda k, rest: np.zeros(len(rest), bool), 3).tolist() == [0, 1, 2]


def test_run_count_grows_with_the_recall():
    assert jaccard.run_count(recall=0.9) < jaccard.run_count(recall=0.999) < jaccard.run_count(recall=0.999, depth=6)


def test_run_count_is_for_the_deepest_paths():
    alive = 1.0
    for _ in range(jaccard.DEPTH):
        alive = 1 - (1 - alive / jaccard.PLACES) ** jaccard.PLACES
    assert 1 - (1 - alive) ** jaccard.run_count() >= jaccard.RECALL


def smallest_plainly(sizes, shards):
    best = [0] + [None] * len(sizes)
    for k in range(shards):
        new = [0] * (len(sizes) + 1)
        for i in range(len(sizes) + 1):
            new[i] = min(max(0 if k == 0 and j == 0 else best[j], sum(sizes[j:i])) for j in range(i + 1) if k or j == 0)
        best = new
    return best[-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=12), st.integers(1, 5))
def test_smallest_capacity_is_the_minimax_one(sizes, shards):
    cells = [(f"{k:03x}", s, 1) for k, s in enumerate(sizes)]
    capacity = sharding.smallest(cells, shards, False)
    assert capacity == smallest_plainly(sizes, shards)
    assert sharding.smallest([(c, s, 2) for c, s, _ in cells], shards, True) <= capacity


def test_base_spans_against_the_patterns():
    cases = {
        "mail a.b@c-d.org, x@y.": [("email", 5, 16)],
        "a@b@c.d": [("email", 2, 7)],
        "@x.y é1@2.3": [("email", 6, 11)],
        "1.2.3.4 256.1.1.1 1.2.3 1.2.3.4.5": [("ip", 0, 7), ("ip", 24, 31)],
        "4111 1111-11111111 4111111111111112": [],
        "4111 1111-1111-1111": [("card", 0, 19)],
        "+1 (437) 555-0689 +123": [("phone", 0, 17)],
        "": [],
    }
    for text, want in cases.items():
        assert [(pii.KINDS[k], a, b) for a, k, b in pii.base_spans(text)] == want, text


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a1.@- é", max_size=24))
def test_emails_as_the_pattern_finds_them(text):
    assert [(a, b) for a, k, b in pii.base_spans(text) if k == 0] == [m.span() for m in EMAIL.finditer(text)]


def test_gradients_of_the_tagger():
    rng = np.random.Generator(np.random.PCG64(1))
    tagger = pii.Tagger(3)
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    tagger.p["move"] += rng.standard_normal(tagger.p["move"].shape) * 0.1
    x, y = rng.integers(0, 100, (6, 3)), rng.integers(0, pii.N_TAGS, (6, 3))
    _, grad = tagger.gradients(x, y)
    for name, value in tagger.p.items():
        at = tuple(rng.integers(0, s) for s in value.shape) if name != "embed" else (int(x[2, 1]), 4)
        old = value[at]
        value[at] = old + 1e-3
        up = tagger.gradients(x, y)[0]
        value[at] = old - 1e-3
        down = tagger.gradients(x, y)[0]
        value[at] = old
        assert grad[name][at] == pytest.approx((up - down) / 2e-3, abs=2e-3), name


def test_decode_is_the_best_path():
    rng = np.random.Generator(np.random.PCG64(2))
    emit = rng.standard_normal((4, 1, pii.N_TAGS))
    emit[-1] = -60
    emit[-1, :, 0] = 0
    move = rng.standard_normal((pii.N_TAGS, pii.N_TAGS))
    path, sure = pii.decode(emit, move)

    def value(tags):
        return sum(emit[t, 0, k] for t, k in enumerate(tags)) + sum(move[a, b] for a, b in itertools.pairwise(tags))

    every = {tags: value(tags) for tags in itertools.product(range(pii.N_TAGS), repeat=4)}
    assert tuple(path[:, 0].tolist()) == max(every, key=every.get)
    total = sum(np.exp(v) for v in every.values())
    for t in range(4):
        assert sure[t, 0] == pytest.approx(sum(np.exp(v) for k, v in every.items() if k[t] == path[t, 0]) / total, rel=1e-6)


def test_tagger_learns_spans_and_finds_them_across_windows():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    mail = lambda: f"{word()}@{word()}.com"
    said = lambda n: " ".join(f"{word()} {mail()} {word()} {rng.randint(1, 99)}" for _ in range(n))
    texts = [said(rng.randint(1, 4)) for _ in range(600)]
    tagger = pii.Tagger()
    losses = tagger.train(*pii.training_windows([(t, pii.base_spans(t)) for t in texts]), steps=400)
    assert losses[-1] < losses[0] / 4
    fresh = ["x" * 500 + " " + said(12) for _ in range(20)]
    wanted = [{s for s in pii.base_spans(t)} for t in fresh]
    found = [set(s) for s in pii.network_spans(fresh, tagger)]
    hits = sum(len(a & b) for a, b in zip(wanted, found, strict=True))
    assert hits > 0.8 * sum(map(len, wanted)) and sum(map(len, found)) <= 1.1 * hits
    assert pii.network_spans([None, "", "no digits here"], tagger) == [[], [], []]


def test_masked():
    assert pii.masked("call +1 22 now", "phone:5:10") == "call <phone> now"
    assert pii.masked(None, "") is None


def test_trigrams_and_mixture_inference():
    rng = random.Random(2)
    speak = {"aa": "abcde", "bb": "vwxyz"}
    word = lambda lang: "".join(rng.choice(speak[lang]) for _ in range(4))
    counts = np.full((1 << langid.BITS, 2), langid.SMOOTH)
    for k, lang in enumerate(speak):
        code, *_ = langid._trigrams(arrow([" ".join(word(lang) for _ in range(3000))]))
        np.add.at(counts[:, k], code, 1)
    model = langid.Model(list(speak), np.log(counts / counts.sum(axis=0)).astype(np.float32))
    mixed = " ".join([word("aa") for _ in range(75)] + [word("bb") for _ in range(25)])
    texts = [" ".join(word("bb") for _ in range(20)), mixed, None, "", "12 34", word("aa")]
    lang, score, chosen = langid.infer(arrow(texts), model)
    assert lang == ["bb", "aa", "und", "und", "und", "aa"]
    assert score[0] > 0.99 and score[1] == pytest.approx(0.75, abs=0.03)
    assert chosen == [["bb"], ["aa", "bb"], [], [], [], ["aa"]]


def test_a_text_in_many_languages_gets_them_all():
    rng = random.Random(3)
    speak = {"aa": "abcd", "bb": "efgh", "cc": "ijkl", "dd": "mnop", "ee": "qrst", "ff": "uvwx"}
    word = lambda lang: "".join(rng.choice(speak[lang]) for _ in range(4))
    counts = np.full((1 << langid.BITS, len(speak)), langid.SMOOTH)
    for k, lang in enumerate(speak):
        code, *_ = langid._trigrams(arrow([" ".join(word(lang) for _ in range(3000))]))
        np.add.at(counts[:, k], code, 1)
    model = langid.Model(list(speak), np.log(counts / counts.sum(axis=0)).astype(np.float32))
    shares = [dict.fromkeys(speak, 60), {"bb": 80, "cc": 60, "dd": 40, "ff": 20}, {"ee": 50}]
    lang, score, chosen = langid.infer(arrow([" ".join(word(x) for x, n in own.items() for _ in range(n)) for own in shares]), model)
    assert [sorted(x) for x in chosen] == [sorted(own) for own in shares]
    assert chosen[1] == ["bb", "cc", "dd", "ff"] and lang[1:] == ["bb", "ee"]
    assert score == pytest.approx([1 / 6, 0.4, 1], abs=0.02) and score[2] == 1


def test_no_mixture_is_likelier_than_the_bound():
    rng = np.random.Generator(np.random.PCG64(4))
    likely = rng.random((60, 4), np.float32) ** 4
    likely /= likely.max(axis=1, keepdims=True)
    cut = np.array([0, 1, 7, 30])
    start = np.full((4, 4), 0.25, np.float32)
    bound = langid._most(likely, cut, langid._fit(likely, cut, start, langid.ROUNDS)[0])
    _, value = langid._fit(likely, cut, start, 5000)
    assert (bound >= value - 1e-3).all() and (bound <= value + 5).all()


def test_template_language():
    render = chat.compile_template("{% for m in messages %}{{ loop.index }}{% if loop.first %}^{% elif m.role == \"b\" and not loop.last %}-{% else %}${% endif %}{{ m.text | trim | upper }}{{ m.none }}{% endfor %}{{ 1 + 2 }}{{ 'x' + 'y\\n' }}")
    assert render([{"role": r, "text": f" {r}c "} for r in "abbz"]) == ("1^AC2-BC3-BC4$ZC3xy\n", [])
    for bad in ("{{ x( ) }}", "{% for x %}{% endfor %}", "{% if x %}", "{{ x.__class__ }}", "{{ _x }}", "{{ x | eval }}", "{% set x = 1 %}", "{{ 'a }}", "{{ a b }}", "{{ }}", "{% endif %}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)


def test_constants_are_folded():
    tree = chat.fold_body(chat.parse("a{{ 'b' + 'c' | upper }}{% if 1 == 2 %}no{% elif true %}d{% else %}e{% endif %}{# f #}g"))
    assert tree == [chat.Text("abCdg")]
    assert chat.fold_body(chat.parse("{% if false %}x{% endif %}")) == []


PIECES = st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "|", "[", "\n", "a", "é", "<|turn|>", "<|done|>\n", "<|says|>"]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), PIECES), PIECES), max_size=4))
def test_conversations_are_read_back(turns):
    formatted, spans = chat.compile_template(chat.TEMPLATE)([{"role": r, "text": t} for r, t in turns])
    assert chat.read_back(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert all(c not in chat.escape(t) for _, t in turns for c in chat.CONTROL)


def test_lines_shapes_and_clusters():
    x = lines.Lines(arrow(["a b 1\n\n  \na b 2\nc", None, "a b 77", "a b c"]))
    assert x.text.tolist() == [0, 0, 0, 2, 3] and x.number.tolist() == [0, 3, 4, 0, 0]
    assert x.shape[0] == x.shape[1] == x.shape[3] and len(set(x.shape.tolist())) == 3
    tokens = np.array([[1, 2, 3, 4], [1, 2, 9, 4], [5, 6, 7, 8], [1, 2, 3, 7]], np.uint32)
    asks = np.array([False, True, True, True])
    assert lines.meet(tokens, [[1, 2, 3], [4], [4], [5]], asks, 3) == {1: [1, 2, 3], 3: [1, 2, 3]}
    assert lines.meet(tokens, [[1], [1], [2], [1]], asks, 3) == {1: [1], 3: [1]}
    assert [lines.least(n) for n in (1, 3, 4, 10, 11, 90)] == [1, 3, 3, 7, 8, 63]


def searched(items, texts, held=1 << 20):
    words, _, first = decontam._words(arrow([" ".join(i) for i in items]))
    batch = pa.RecordBatch.from_arrays([arrow([" ".join(t) for t in texts])], names=["text"])
    shared = [lambda: ([str(k) for k in range(len(items))], words, first)]
    return [r["m"] for b in decontam._search(iter([batch]), "text", "m", shared, 10) for r in b.to_pylist()]


def matches_plainly(items, t):
    """Hit words, and for each item with a window in the text its longest match: words, place, place in the item."""
    hit, best = set(), {}
    for k, item in enumerate(items):
        n = min(10, len(item))
        for i in range(len(item) - n + 1 if n else 0):
            for p in range(len(t) - n + 1):
                if t[p : p + n] == item[i : i + n]:
                    hit |= set(range(p, p + n))
                    m = n
                    while p + m < len(t) and i + m < len(item) and t[p + m] == item[i + m]:
                        m += 1
                    best[str(k)] = min(best.get(str(k), (0, 0, 0)), (-m, p, i))
    return hit, {k: (-m, p, i) for k, (m, p, i) in best.items()}


def test_windows_and_longest_matches_of_a_benchmark_block():
    rng = random.Random(9)
    word = lambda: rng.choice(["ab", "cd", "e", "f"])
    items = [[word() for _ in range(n)] for n in (0, 1, 3, 12, 14, 40)]
    texts = [[word() for _ in range(rng.randint(0, 60))] for _ in range(40)]
    texts[3][10:22] = items[3]
    texts[4] = items[4] + items[3]
    texts[5] = items[5][3:31] + items[5][2:18] + items[5]
    for t, row in zip(texts, searched(items, texts), strict=True):
        hit, best = matches_plainly(items, t)
        assert row["n_words"] == len(t) and {x for s in row["spans"] for x in range(s["first"], s["end"])} == hit
        assert {m["item"]: (m["words"], m["first"], m["item_first"]) for m in row["matches"]} == best


def test_no_match_is_longer_than_what_one_item_has():
    a = [f"a{k}" for k in range(11)]
    items = [a, [*a[1:], "zz", "yy"]]
    (row,) = searched(items, [[*a, "zz", "yy"]])
    assert [(m["item"], m["words"], m["first"], m["item_first"]) for m in row["matches"]] == [("0", 11, 0, 0), ("1", 12, 1, 0)]


def test_latent_space_separates_and_scores_empty_texts():
    rng = random.Random(4)
    good = [" ".join(rng.choice(["lake", "tree", "walk", "bird"]) for _ in range(30)) for _ in range(40)]
    bad = [" ".join(rng.choice(["###", "BUY!!", "$$$", "NOW!!"]) for _ in range(30)) for _ in range(40)]
    row, column, value = neighbours.features(arrow(good + bad))
    space = neighbours.fit(row, column, value, [1] * 40 + [0] * 40, 0.5)
    score = space.scores(arrow(["lake bird walk tree lake", "$$$ BUY!! ### NOW!!", None, ""]))
    assert score[0] > 0.9 and score[1] < 0.1 and score[2] == score[3] and 0 <= score[2] <= 1
