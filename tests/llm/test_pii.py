import hashlib
import random
import re

from sluice.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text):
    out = []
    for k, (kind, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (12 <= len(d) <= 19 and luhn(d)) \
                    or kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


ODD = [None, "", "a@b.c@d.e x@y", "a@b.c_d@x.y.z", "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4", "+1 (555) 123-4567. +12", "4111 1111 1111 1111x4111-1111-1111-1112",
       "é😀 a@b.co 4111111111111111", "7" * 20000, "1 " * 20000, "9.9." * 3000, "a" * 30000 + "@b", "٣.1.2.3", "+1+1+123456789", "a@b..c a@b.c."]


def test_base_spans_equal_plain_patterns(documents):
    rng = random.Random(3)
    docs = list(enumerate(ODD)) + [(100 + i, "".join(rng.choices("a1@.+- (9)\nb4", k=rng.randint(0, 60)))) for i in range(300)]
    docs += [(None, "x a@b.cd"), (2, ODD[2])]
    got = sorted((str(r.doc_id), r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.report(documents(docs).repartition(3)).collect())
    want = []
    for d, t in docs:
        b = base(t)
        want.append((str(d), hashlib.sha256(b.encode()).hexdigest(), *[b.count(k + ":") for k in PLAIN]))
    assert got == sorted(want)




def test_contexts_find_what_the_patterns_miss(documents):
    docs = [(i, f"my ident 10.{i}.3.4 ok") for i in range(40)] + [(100, "his ident 10.3.4.999 ok"), (101, "ident 1.2 ok"), (102, "room 10.3.4.999")]
    got = {r.doc_id: r.spans for r in pii.report(documents(docs)).collect()}
    assert got[100] == "context:10:20" and got[101] == "" and got[102] == "" and got[5] == "ip:9:17"


def test_few_seeds_teach_nothing(documents):
    got = pii.report(documents([(i, f"ident 10.{i}.3.4") for i in range(3)] + [(9, "ident 10.3.4.999")])).collect()
    assert {r.spans for r in got if r.doc_id == 9} == {""}


def test_half_seeds_teach_nothing(documents):
    # a pattern must not hand its own score back to itself
    docs = [(i, f"the 10.{i}.3.4 ok") for i in range(50)] + [(100 + i, f"the 10.{i}.3.999 ok") for i in range(50)]
    assert {r.spans for r in pii.report(documents(docs)).collect() if r.doc_id >= 100} == {""}


def test_contexts_find_unseen_shapes_and_blanks(documents):
    docs = [(i, f"call tel +1 555 {100 + i} 4567 now or a") for i in range(20)]
    docs += [(50 + i, f"pay card 5105 {1000 + i} {2000 + i} {luhn_end(f'5105{1000 + i}{2000 + i}')} today") for i in range(20)]
    docs += [(100, "his tel 555 123 4567 now"), (101, "her card 4111 1111 1111 1112 today"), (102, "new tel (017) 555-7713, ok"),
             (103, "old card AB/99-1234x today"), (104, "room 555 123 4567 free"), (105, "tel:+1 555 321 4567 and 12 034567 now"),
             (106, "555 987 6543 now")]
    got = {r.doc_id: r.spans for r in pii.report(documents(docs)).collect()}
    assert got[0] == "phone:9:24" and got[50] == "card:9:28"
    assert got[100] == "context:8:20" and got[101] == "context:9:28" and got[102] == "context:8:22"
    assert got[103] == "context:9:20" and got[104] == "" and got[105].startswith("phone:4:19") and got[106] == "context:0:12"


def luhn_end(head):
    return next(f"{x:04d}" for x in range(10) if luhn(f"{head}{x:04d}"))


def test_scores_equal_plain_rounds(spark):
    rng = random.Random(5)
    edges = {(f"p{rng.randrange(8)}", f"t{rng.randrange(40)}"): rng.random() < 0.6 for _ in range(150)}
    want = {}
    for _ in range(4):
        old, want = want, {}
        for p in {p for p, _ in edges}:
            mine = [t for q, t in edges if q == p]
            worth = [1 if edges[p, t] else 0.9 * max([old.get(q, 0) for q, u in edges if u == t and q != p], default=0) for t in mine]
            want[p] = sum(worth) / (len(mine) + 1)
    got = pii.scored(spark.createDataFrame([(p, t, s) for (p, t), s in edges.items()], "pattern string, token string, seed boolean"))
    assert {r.pattern: round(r.score, 9) for r in got.collect()} == {p: round(x, 9) for p, x in want.items()}


def test_redaction(documents):
    df = documents([(1, "é mail a@b.co, +1 555 123 4567 end"), (2, "clean"), (3, None), (1, "é mail a@b.co, +1 555 123 4567 end"), (None, "z@y.xw")])
    out = pii.redacted(df)
    assert out.columns == df.columns
    got = sorted((str(r.doc_id), r.text, r.n_chars) for r in out.collect())
    red = "é mail [EMAIL], [PHONE] end"
    assert got == [("1", red, len(red)), ("1", red, len(red)), ("2", "clean", 5), ("3", None, None), ("None", "[EMAIL]", 7)]


def test_empty_table(documents):
    assert pii.report(documents([])).collect() == [] and pii.redacted(documents([])).collect() == []


def test_main_path_has_no_python(documents, capsys):
    pii.spans(documents([(1, "a@b.co")])).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


def test_words_of_plain_prose_mark_nothing(documents):
    seeds = [(i, f"pay of 10.{i}.3.4 now and 10.{i}.9.9 then ident 10.{i}.7.7 ok") for i in range(20)]
    prose = [(100 + i, "some of the words and more of them and so on") for i in range(60)]
    odd = [(900, "out of 1234567890123456 and 9876543210987654 in"), (901, "ident 10.3.4.999 ok")]
    got = {r.doc_id: r.spans for r in pii.report(documents(seeds + prose + odd)).collect()}
    assert got[900] == "" and got[901] == "context:6:16"


def test_contexts_reach_as_far_as_the_next_word(documents):
    far = "-" * 200
    docs = [(i, f"10.{i}.3.4 {far} label") for i in range(40)] + [(50, f"10.3.4.999 {far} label"), (51, "10.3.4.998 label 10.3.4.997 label")]
    got = {r.doc_id: r.spans for r in pii.report(documents(docs)).collect()}
    assert got[50] == "context:0:10" and got[51] == "context:0:10,context:17:27"


def test_no_discovery_on_the_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kinds = [s.split(":")[0] for r in pii.report(docs).collect() for s in r.spans.split(",") if s]
    assert kinds and "context" not in kinds


def test_very_many_matches_keep_their_places(documents):
    n = 3000
    docs = [(1, "".join(f"{'x' * (i % 3)} é@b.co1 10.0.0.{i % 300}\n" for i in range(n))), (2, "a@b.co " * 512), (3, "a@b.co " * 513)]
    got = {r.doc_id: r for r in pii.report(documents(docs)).collect()}
    for d, t in docs:
        assert got[d].base_sha256 == hashlib.sha256(base(t).encode()).hexdigest()


def test_a_text_is_searched_for_instances_once_and_split_once(documents):
    plan = pii.located_tokens(documents([(1, "a@b.co")]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("){1,18}+") == 2 and plan.count("CASE WHEN RLIKE(masked") == 2


def test_words_without_signs_do_not_hide_instances(documents):
    docs = [(i, f"mail  call  ident\n10.{i}.3.4 ok") for i in range(40)]
    docs += [(100, "10.3.4.999"), (101, "plain words only"), (102, "ident 10.3.4.999"), (103, "é ident\t \n10.3.4.999 ok ident 10.3.4.998")]
    got = {r.doc_id: r.spans for r in pii.report(documents(docs)).collect()}
    assert got[100] == got[101] == "" and got[102] == "context:6:16" and got[103] == "context:10:20,context:30:40"
