"""Each operator on small tables: nulls, empty and long texts, ties, repeated rows, no rows, clashing columns; against brute force."""

import collections
import datetime
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gridloom.llm import fingerprint, html_text, lines, mixing, near_dup, pii, segment, suffixes, topk, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "long " * 20_000
ODD = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (None, "no id here", "en", "a", 10), (3, LONG, "en", "b", len(LONG)), (4, "the same row", "en", "a", 12), (4, "the same row", "en", "a", 12), (4, "another text of that id", "en", "a", 23)]


def docs(spark, rows=ODD):
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """Columns by names that operators use inside."""
    names = "key size signature rank copies score n root at line place leaf template bucket spans vector block part edge _key _size _found row found new kept after _d _s _w _n".split()
    return df.select("*", *[F.lit("x").alias(c) for c in names if c not in df.columns])


# Mixing


def test_mixing_meets_targets_and_limits(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), "en", rng.choice(["hot", "hot", "hot", "s1", "s2", None]), 0) for i in range(3000)]
    plan = mixing.mix_plan(docs(spark, rows)).collect()
    assert len(plan) == 3000
    got, target, size, biggest = collections.Counter(), {}, {}, collections.Counter()
    for r in plan:
        got[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.source_size
        biggest[r.source] = max(biggest[r.source], r.size)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    for s in got:
        assert abs(got[s] - target[s]) <= 3 * biggest[s] and target[s] <= 2 * size[s] + 1e-6
    assert sorted(plan, key=str) == sorted(mixing.mix_plan(docs(spark, rows).repartition(7)).collect(), key=str)


def test_mixing_odd_rows(spark):
    plan = mixing.mix_plan(clashing(docs(spark))).collect()
    assert len(plan) == len(ODD) and {r.size for r in plan if r.doc_id in (1, 2)} == {0}
    out = mixing.mixed(docs(spark))
    assert out.columns == docs(spark).columns
    assert out.count() == sum(r.copies for r in plan)
    more = mixing.mixed(clashing(docs(spark)))
    assert more.columns == clashing(docs(spark)).columns and more.count() == out.count() and {r["_key"] for r in more.collect()} == {"x"}
    assert mixing.mix_plan(docs(spark, [])).count() == mixing.mixed(docs(spark, [])).count() == 0


# Pseudonyms


def test_pseudonyms_keep_formats_and_links(spark):
    text = "Ann born 1980-02-29, 02/29/1980 or 29.02.1980; card 4111 1111 1111 1111 or 4111111111111111, not 4111111111111112; mail a.b@mail1.example.com, +1 (988) 555-2485, +44 20 7946 0958, ip 42.144.35.254 not 300.1.1.1, ssn 123-45-6789 not 000-12-3456, DE89 3704 0044 0532 0130 00"
    r, again = pii.pseudonymised(docs(spark, [(1, text, "", "", 0), (2, "card 4111111111111111 on 1980-02-29", "", "", 0)])).orderBy("doc_id").collect()
    kinds = [x.kind for x in r.private]
    assert kinds == "date date date card card email nanp phone ip ssn iban".split() and r.n_private == 11
    new = [x.pseudonym for x in r.private]
    day = datetime.date.fromisoformat(new[0])
    assert new[1] == day.strftime("%m/%d/") + f"{day.year:04}" and new[2] == day.strftime("%d.%m.") + f"{day.year:04}"
    assert [x.pseudonym for x in again.private] == [new[4], new[0]] and new[3].replace(" ", "") == new[4]
    assert sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, new[4][::-1]))) % 10 == 0
    iban = new[10].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    for left in ("4111111111111112", "300.1.1.1", "000-12-3456"):
        assert left in r.text
    for gone in ("1980-02-29", "4111 1111 1111 1111", "a.b@mail1", "555-2485", "42.144", "123-45", "3704"):
        assert gone not in r.text
    shape = lambda s: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "9", s)))
    mask = lambda s: re.sub(r"\b[0-9]{1,3}(\.[0-9]{1,3}){3}\b", "IP", s)
    assert shape(mask(r.text)) == shape(mask(text))


# The same in plain Python.


def _prf(tag, i, value):
    return hashlib.sha256(f"{pii.KEY}|{tag}|{i}|{value}".encode()).hexdigest()


def _int(x, a, b, tag):
    l, r = divmod(x, b)
    for i in range(pii.ROUNDS):
        by = int(_prf(tag, i, r if i % 2 == 0 else l)[:13], 16)
        l, r = ((l + by) % a, r) if i % 2 == 0 else (l, (r + by) % b)
    return l * b + r


def _text(s, mask, tag):
    half = len(s) // 2
    parts, masks = [s[:half], s[half:]], [mask[:half], mask[half:]]
    low = {"d": (48, 10), "n": (50, 8), "l": (97, 26), "U": (65, 26)}
    for i in range(pii.ROUNDS):
        k = i % 2
        by = _prf(tag, i, f"{mask}|{parts[1 - k]}")
        new = ""
        for j, (c, m) in enumerate(zip(parts[k], masks[k])):
            n = int(by[j * 4 % 64 : j * 4 % 64 + 4], 16)
            new += chr(low[m][0] + (ord(c) - low[m][0] + n) % low[m][1]) if m in low else c
        parts[k] = new
    return "".join(parts)


def _mask(s):
    return "".join("d" if c in "0123456789" else "l" if "a" <= c <= "z" else "U" if "A" <= c <= "Z" else "." for c in s)


def _fill(form, symbols):
    it = iter(symbols)
    return "".join(next(it) if c.isascii() and c.isalnum() else c for c in form)


def _luhn(d):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(d[::-1]))


def _plain_pseudonym(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "email":
        at = m.rindex(".") + 1
        new = _text(m[:at].lower(), _mask(m[:at].lower()), "email")
        return "".join(n.upper() if c.isupper() else n for c, n in zip(m[:at], new)) + m[at:]
    if kind == "ip":
        x = _int(int.from_bytes(bytes(map(int, m.split(".")))), 65536, 65536, "ip")
        return ".".join(map(str, x.to_bytes(4)))
    if kind == "ssn":
        a, g, n = map(int, m.split("-"))
        x = _int(((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + n - 1, 898 * 99, 9999, "ssn")
        a = x // (99 * 9999) + 1
        return f"{a + (a >= 666):03}-{x // 9999 % 99 + 1:02}-{x % 9999 + 1:04}"
    if kind == "date":
        day = datetime.date(1800, 1, 1) + datetime.timedelta(_int((datetime.date.fromisoformat(m) - datetime.date(1800, 1, 1)).days, 189, 773, "date"))
        return day.isoformat()
    if kind == "nanp":
        head = re.match(r"(\+?1[ .-]?(?=[(2-9]))?", m)[0]
        return head + _fill(m[len(head) :], _text(re.sub("[^0-9]", "", m[len(head) :]), "nddndddddd", "nanp"))
    if kind == "phone":
        return _fill(m, _text(d, "xx" + "d" * (len(d) - 2), "phone"))
    if kind == "card":
        fixed = "xx" if d[0] == "2" else "x"
        new = _text(d[:-1], fixed + "d" * (len(d) - 1 - len(fixed)), "card")
        return _fill(m, new + str(-_luhn(new + "0") % 10))
    s = m.replace(" ", "")
    new = _text(s[4:], _mask(s[4:]), "iban")
    check = 98 - int("".join(str(int(c, 36)) for c in new + s[:2] + "00")) % 97
    return _fill(m, f"{s[:2]}{check:02}{new}")


def test_pseudonyms_against_plain_code(spark):
    rng = random.Random(21)
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    values = []
    for i in range(25):
        values.append(("email", "".join(rng.choices("aBcD.9", k=3)).strip(".") + f"x{i}@Mail{i}.Example.com"))
        values.append(("ip", ".".join(str(rng.randint(0, 255)) for _ in range(4))))
        values.append(("ssn", f"{rng.randint(1, 665):03}-{rng.randint(1, 99):02}-{rng.randint(1, 9999):04}"))
        values.append(("date", (datetime.date(1800, 1, 1) + datetime.timedelta(rng.randrange(146_097))).isoformat()))
        values.append(("nanp", rng.choice(["+1 {}-{}-{}", "({}) {}-{}", "+1{}{}{}", "{}.{}.{}"]).format(f"{rng.randint(200, 999)}", f"{rng.randint(200, 999)}", digits(4))))
        values.append(("phone", f"+4{rng.randint(1, 9)} {digits(4)} {digits(4)}"))
        body = rng.choice(["22", "27", "4", "51", "6"]) + digits(13)
        body = body[:15].ljust(15, "7")
        values.append(("card", body + str(-_luhn(body + "0") % 10)))
        bban = digits(18)
        values.append(("iban", f"DE{98 - int(bban + '131400') % 97:02}{bban}"))
    rows = [(i, f"see {v} here", "", "", 0) for i, (_, v) in enumerate(values)]
    for r in pii.pseudonymised(docs(spark, rows)).withColumn("again", pii.kind_of(F.element_at("private", 1)["pseudonym"])).collect():
        kind, value = values[r.doc_id]
        assert [(x.kind, x.pseudonym) for x in r.private] == [(kind, _plain_pseudonym(kind, value))], value
        assert r.text == f"see {r.private[0].pseudonym} here" and r.again == kind


def test_pseudonyms_are_linked_across_forms(spark):
    text = "Ann@Example.com ann@example.com; +1 212-555-0143, +12125550143, (212) 555-0143; 2221 0000 0000 0009 2221000000000009"
    r = pii.pseudonymised(docs(spark, [(1, text, "", "", 0)])).first()
    new = [x.pseudonym for x in r.private]
    assert [x.kind for x in r.private] == "email email nanp nanp nanp card card".split()
    assert new[0].lower() == new[1] and new[0][0].isupper()
    plain = lambda s: re.sub("[^0-9]", "", s)[-10:]
    assert plain(new[2]) == plain(new[3]) == plain(new[4]) and plain(new[5]) == plain(new[6])
    assert all(x.startswith("222") or x[:2] == "22" for x in new[5:])


def test_feistel_is_a_permutation(spark):
    out = spark.range(35).select(pii.permuted_int(F.col("id"), 5, 7, "k", "t").alias("x"))
    assert sorted(r.x for r in out.collect()) == list(range(35))
    codes = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("s"))
    moved = codes.select(pii.permuted_text(F.col("s"), F.lit("ddd"), "k", "t").alias("x")).collect()
    assert len({r.x for r in moved}) == 1000 and all(re.fullmatch("[0-9]{3}", r.x) for r in moved)


def test_pseudonyms_odd_rows(spark):
    out = pii.pseudonymised(clashing(docs(spark)))
    rows = {(r.doc_id, r.text) for r in out.collect()}
    assert out.count() == len(ODD) and (1, None) in rows and (2, "") in rows and (3, LONG) in rows
    assert pii.pseudonymised(docs(spark, [])).count() == 0


# Line dedup


def test_recurring_templates_are_dropped(spark):
    rng = random.Random(3)
    own = lambda: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(12))
    rows = []
    for i in range(40):
        parts = [own(), own(), own()]
        if i < 15:
            parts.insert(1, f"Posted on day {i} by the staff of this site")
        if i < 9:
            parts.append("seen in nine texts only , and so kept")
        rows.append((i, "\n".join(parts), "", "", 0))
    copy = "\n".join([own(), own()])
    rows += [(100 + i, copy, "", "", 0) for i in range(30)]  # copies are one text
    got = {r.doc_id: r for r in lines.without_recurring_lines(docs(spark, rows)).collect()}
    for i, text, *_ in rows:
        want = "\n".join(x for x in text.split("\n") if not x.startswith("Posted on"))
        assert got[i].text == want and got[i].n_dropped == (i < 15)


def test_recurring_lines_go_whatever_their_share_and_length(spark):
    line = "All rights to this page are with its authors"
    rows = [(i, f"{line}\nown{chr(97 + i)} word{chr(97 + i)}", "", "", 0) for i in range(26)]
    rows += [(100 + i, f"Read more\nPage {i}\n\n{line}\n-", "", "", 0) for i in range(12)]
    got = {r.doc_id: r for r in lines.without_recurring_lines(docs(spark, rows)).collect()}
    assert all(got[i].text == t.split("\n")[1] and got[i].n_dropped == 1 for i, t, *_ in rows[:26])
    assert all(got[100 + i].text == "" and got[100 + i].n_dropped == 4 and got[100 + i].n_lines == 5 for i in range(12))


def test_recurring_lines_go_and_near_copies_count_once(spark):
    rng = random.Random(4)
    own = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    common = "All of the articles of this site are free to read and to share with others"
    rows = [(i, f"{own(40)}\n{common}", "", "", 0) for i in range(15)] + [(50 + i, f"{common}\n{own(2)}", "", "", 0) for i in range(5)]
    base = [own(12) for _ in range(8)]  # near copies of one text, each with a line of its own
    rows += [(100 + i, "\n".join([*base[: i % 8], own(12), *base[i % 8 + 1 :], common]), "", "", 0) for i in range(24)]
    got = {r.doc_id: r for r in lines.without_recurring_lines(docs(spark, rows), by_group=True).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        assert got[i].text == "\n".join(x for x in text.split("\n") if x != common) and got[i].n_dropped == 1
    whole = [(i, f"the one line that all of these share\nanother shared line of them all\n{i}", "", "", 0) for i in range(20)]
    assert all(r.n_dropped == 0 for r in lines.without_recurring_lines(docs(spark, whole), by_group=True).collect())


def test_line_dedup_odd_rows(spark):
    out = lines.without_recurring_lines(clashing(docs(spark)))
    assert {(r.doc_id, r.text, r.n_dropped) for r in out.collect()} == {(r[0], r[1], 0) for r in ODD} and out.count() == len(ODD)
    assert lines.without_recurring_lines(docs(spark, [])).count() == 0


# Near duplicates


def _components(rows):
    """Brute force over all pairs of texts."""
    first, parent = {}, {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, t, *_ in rows:
        parent[i] = i
        key = t if t and t.strip() else ""
        if key in first:
            parent[find(i)] = find(first[key])
        else:
            first[key] = i
    s = {i: near_dup.shingles(t) for t, i in first.items() if t}
    ids = list(s)
    for a in range(len(ids)):
        for b in range(a):
            if near_dup.overlap(s[ids[a]], s[ids[b]]) >= near_dup.SIMILAR:
                x, y = find(ids[a]), find(ids[b])
                parent[max(x, y)] = min(x, y)
    groups = collections.defaultdict(list)
    for i in parent:
        groups[find(i)].append(i)
    return {i: min(g) for g in groups.values() for i in g}


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(3000)]
    rows = []

    def edited(base, n):
        w = list(base)
        for _ in range(n):
            w[rng.randrange(len(w))] = rng.choice(words)
        return w

    base = rng.choices(words, k=150)
    for _ in range(160):  # a group whose members are near to the base, or not quite, and to each other or not
        rows.append(edited(base, rng.choice([1, 2, 3, 4, 6, 9])))
    half = rng.choices(words, k=300)
    for n in range(60):  # texts cut out of a longer one, near to each other in turn
        rows.append(half[: 120 + 3 * n])
    for _ in range(40):
        other = rng.choices(words, k=rng.randint(3, 80))
        rows += [other, edited(other, rng.randint(0, 2))]
    order = list(range(len(rows)))
    rng.shuffle(order)
    rows = [(k, " ".join(r), "", "", 0) for k, r in zip(order, rows)] + [(9000 + i, "", "", "", 0) for i in range(3)] + [(9003, None, "", "", 0), (9004, " \n", "", "", 0)]
    want = _components(rows)
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(docs(spark, rows)).collect()}
    assert got == want
    kept = near_dup.deduplicated(docs(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_near_duplicates_odd_rows(spark):
    out = near_dup.near_duplicates(clashing(docs(spark))).collect()
    assert len(out) == len(ODD)
    kept = near_dup.deduplicated(clashing(docs(spark))).collect()
    assert {r["_key"] for r in kept} == {"x"} == {r.key for r in kept}
    assert sorted(str((r.doc_id, (r.text or "")[:9])) for r in kept) == sorted(map(str, [(1, ""), (3, "long long"), (4, "the same "), (4, "another t"), (None, "no id her")]))
    assert near_dup.near_duplicates(docs(spark, [])).count() == near_dup.deduplicated(docs(spark, [])).count() == 0


# Suffix dedup


def _without_repeats(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        mask = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            if w in seen:
                mask[s : s + 100] = b"\1" * 100
            else:
                seen.add(w)
        spans = sum(1 for k in range(len(mask)) if mask[k] and not (k and mask[k - 1]))
        out[i] = (len(b), sum(mask), spans, hashlib.sha256(bytes(x for x, f in zip(b, mask) if not f)).hexdigest())
    return out


@pytest.mark.parametrize("hot", [suffixes.HOT, 3])
def test_suffix_dedup_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    rng = random.Random(6)
    base = ["".join(rng.choices("abcd é", k=600)) for _ in range(4)]
    rows = []
    for i in range(80):
        t = ""
        for _ in range(rng.randint(0, 6)):
            s = rng.randrange(500)
            t += rng.choice(base)[s : s + rng.randint(1, 300)] + rng.choice("xyz") * rng.randint(0, 3)
        rows.append((i * 3 - 7, t))
    rows += [(1000, None), (1001, ""), (1002, "ab" * 400), (1003, "a" * 500), (1004, "ab" * 200)]
    got = suffixes.without_repeats(docs(spark, [(*r, "", "", 0) for r in rows])).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == _without_repeats(rows)


def test_suffix_dedup_odd_rows(spark):
    got = suffixes.without_repeats(clashing(docs(spark))).collect()
    assert len(got) == len(ODD)
    assert {r.n_removed for r in got if r.doc_id == 4} == {0}
    (long,) = [r for r in got if r.doc_id == 3]
    assert long.n_bytes == len(LONG) and long.n_removed == len(LONG) - 5 and long.n_spans == 1
    assert suffixes.without_repeats(docs(spark, [])).count() == 0


# Fingerprints


def test_edit_fingerprints_against_plain_code(spark):
    rng = random.Random(7)
    rows = [(i * 7 % 101, " ".join(rng.choices(["ab", "cd", "é", "xyz"], k=rng.randint(0, 40))), "", "", 0) for i in range(60)]
    got = {r.doc_id: r for r in fingerprint.edit_fingerprints(docs(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for a, b in zip(order, order[1:] + order[:1]):
        changed = fingerprint.edited(a[1], b[1])
        r = got[a[0]]
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest() and r.n_chars == len(a[1])
        assert r.fingerprint == fingerprint.fingerprint(a[1]).hex() and r.edited_fingerprint == fingerprint.fingerprint(changed).hex()
        assert r.near_next == fingerprint.likeness(fingerprint.fingerprint(a[1]), fingerprint.fingerprint(b[1]))


def test_near_pairs_finds_all_within_the_radius(spark):
    rng = random.Random(8)
    prints = [rng.getrandbits(256) for _ in range(20)]
    for p in prints[:15]:
        for _ in range(3):
            prints.append(p ^ sum(1 << b for b in rng.sample(range(256), rng.randint(0, 10))))
    rows = [(i, f"{p:064x}") for i, p in enumerate(prints)]
    pairs, members = fingerprint.near_pairs(spark.createDataFrame(rows, "doc_id long, fingerprint string"), 7)
    rep = {}
    for i, f in rows:
        rep.setdefault(f, i)
    want = {(min(rep[a], rep[b]), max(rep[a], rep[b]), (int(a, 16) ^ int(b, 16)).bit_count()) for a in rep for b in rep if a < b and (int(a, 16) ^ int(b, 16)).bit_count() <= 7}
    assert {tuple(r) for r in pairs.collect()} == want
    assert {(r.doc_id, r.class_id) for r in members.collect()} == {(i, rep[f]) for i, f in rows}


def test_links_within_a_radius(spark):
    rows = [(1, "one two three four five six seven eight", "", "", 0), (2, "one two three four five six seven eight", "", "", 0), (3, "other words than these there are none", "", "", 0), (4, None, "", "", 0)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in fingerprint.links_within(clashing(docs(spark, rows))).collect()}
    assert got == {1: (1, 0), 2: (1, 0), 3: (3, 0), 4: (4, 0)}
    prints = {i: int(fingerprint.fingerprint(t).hex(), 16) for i, t, *_ in rows if t}
    assert (prints[1] ^ prints[3]).bit_count() > 7


def test_fingerprints_odd_rows(spark):
    assert fingerprint.edit_fingerprints(clashing(docs(spark))).count() == len(ODD)
    one = fingerprint.edit_fingerprints(docs(spark, ODD[3:4])).first()
    assert one.near_next == 1 and fingerprint.edit_fingerprints(docs(spark, [])).count() == 0
    assert fingerprint.fingerprints(docs(spark)).count() == len(ODD)


# Top-k


def test_top_k_against_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, [rng.randint(-3, 3) for _ in range(4)]) for i in range(300)] + [(1000 + i, [1, 1, 1, 1]) for i in range(60)] + [(2000, []), (2001, [2])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    got = collections.defaultdict(list)
    for r in topk.top_k(df, df.filter("vec_id % 50 = 0"), 5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    for q, v in rows:
        if q % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q]
            assert got[q] == [(i, -s) for s, i in sorted(scores)[:5]], q


def test_top_k_odd_rows(spark):
    rows = [(0, [0.5, -0.25], 1), (None, [1.0, 1.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 1), (5, [0.1, 0.1], 1), (5, [0.1, 0.1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").filter(F.col("vec_id").isNotNull() & topk.usable(F.col("embedding")))
    df = df.select("vec_id", topk.quantised(F.col("embedding")).alias("vector"))
    got = topk.top_k(df, df.filter("vec_id = 0"), 5).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 5, 25 * 128 - 25 * 64), (0, 2, 5, 25 * 64)]
    with pytest.raises(ValueError, match="53 bits"):
        big = spark.createDataFrame([(0, [1 << 30]), (1, [1 << 30])], "vec_id long, vector array<long>")
        topk.top_k(big, big, 1)
    assert topk.top_k(df.limit(0), df.limit(0), 5).count() == 0 and topk.top_k(df, df.limit(0), 5).count() == 0


# Toxicity


def _labelled(n=900):
    rng = random.Random(10)
    words = ["".join(rng.choices("abcdefghijkl", k=rng.randint(2, 7))) for _ in range(4000)]
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        w = rng.choices(words, k=rng.randint(30, 80))
        if bad:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["vilewort", "zotz", "vilekraut"])
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_labels(spark):
    rows, labels = _labelled()
    l = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.score(docs(spark, rows), l).withColumn("h", toxicity.held_out(F.col("doc_id"))).join(l, "doc_id").collect()
    held = [r for r in out if r.h]
    assert len(out) == len(rows) and len(held) > 150
    assert sum((r.score >= toxicity.THRESHOLD) == bool(r.toxic) for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in out)
    kept = {r.doc_id for r in toxicity.without_toxic(docs(spark, rows), l).collect()}
    assert kept == {r.doc_id for r in out if r.score < toxicity.THRESHOLD}


def test_toxicity_never_learns_from_held_out_rows(spark):
    rows, labels = _labelled(300)
    flipped = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    plain = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    a = {r.doc_id: r.score for r in toxicity.score(docs(spark, rows), plain).collect()}
    assert a == {r.doc_id: r.score for r in toxicity.score(docs(spark, rows), flipped).collect()}


def test_toxicity_looks_at_all_words(spark):
    rows, labels = _labelled(300)
    rng = random.Random(12)
    plain = " ".join("".join(rng.choices("mnopqrst", k=6)) for _ in range(40))  # toxic, without a word that other examples have
    free = [i for i in range(5000, 5100) if zlib.crc32(str(i).encode()) % 4 != 2][0]
    rows += [(free, plain, "en", "s", 0), (6000, f"{plain} more", "en", "s", 0)]
    out = toxicity.score(docs(spark, rows), spark.createDataFrame([*labels, (free, 1, 1)], "doc_id long, quality int, toxic int")).collect()
    got = {r.doc_id: r for r in out}
    assert got[6000].evidence[0] == free and got[6000].score > got[next(i for i, _, t in labels if not t)].score


def test_toxicity_keeps_all_telling_terms(spark):
    vile = " ".join(f"{a}{b}{c}" for a in "bcdfghjklmnpqrstvwxz" for b in "aeiouy" for c in ("rax", "rix", *[f"{x}{y}k" for x in "aeiou" for y in "lmnrstv"]))
    free = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, f"{vile} {'x' * (i + 1)}" if n < 10 else f"plain words {'z' * (i + 1)}", "en", "s", 0) for n, i in enumerate(free)]
    labels = spark.createDataFrame([(i, 1, int(n < 10)) for n, i in enumerate(free)], "doc_id long, quality int, toxic int")
    model, _ = toxicity.fit(docs(spark, rows), labels)
    assert len(model.value.words.telling) > len(vile.split()) > 4096
    assert model.value.votes([f"{vile} x", "plain words"])[0][0] > 0.5


def test_toxicity_words_that_no_example_has(spark):
    """They weigh alike, whether the corpus is full of them or not."""
    rows, labels = _labelled(300)
    rows += [(6000 + i, f"{rows[0][1]} wuwuwu", "en", "s", 0) for i in range(50)] + [(7000, f"{rows[0][1]} yuyuyu", "en", "s", 0)]
    out = toxicity.score(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    scores = {r.doc_id: r.score for r in out.collect() if r.doc_id >= 6000}
    assert len(scores) == 51 and len(set(scores.values())) == 1


def test_toxicity_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.score(clashing(docs(spark)), none).collect()
    assert len(out) == len(ODD) and {r.score for r in out} == {0.0}
    some = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (4, 1, None), (None, 1, 1), (3, 0, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.score(docs(spark), some).count() == len(ODD)
    assert toxicity.score(docs(spark, []), some).count() == 0
    assert toxicity.without_toxic(docs(spark), none).count() == len(ODD)


# Pages and pieces


def test_pages(spark):
    rows = [(1, "u", "<article><p>The words of it and that is all of the text that this page has for you.</p></article>"), (2, None, None), (2, None, None), (3, "v", "")]
    got = html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))).collect()
    assert len(got) == 4 and {r.page_id: r.n_chars for r in got} == {1: 71, 2: 0, 3: 0}
    assert html_text.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_encode_and_decode(spark):
    rows = [*ODD, (7, "日本 ▁ \n\n the  end", "", "", 0)]
    out = segment.encode(clashing(docs(spark, rows)))
    got = out.collect()
    assert all(r.round_trip and r.n_tokens == len(r.ids) and 0 < r.inclusion <= 1 for r in got)
    assert collections.Counter(r.doc_id for r in got) == {1: 1, 2: 1, None: 2, 3: 2, 4: 6, 7: 2}
    again = {(r.doc_id, r.sample, tuple(r.ids)) for r in segment.encode(docs(spark, rows).repartition(3)).collect()}
    assert again == {(r.doc_id, r.sample, tuple(r.ids)) for r in got}
    texts = {(r.doc_id, r.text) for r in segment.decode(out).collect()}
    assert texts == {(r[0], r[1] or "") for r in rows}
    assert segment.encode(docs(spark, [])).count() == 0
