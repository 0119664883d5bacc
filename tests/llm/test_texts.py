import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pagelode.llm import mixing, sentences, tokens

CASES = {
    "Dr. A. B. Ox met Mrs. Lee at 7.30 p.m. on Nov. 5. She left.": ["Dr. A. B. Ox met Mrs. Lee at 7.30 p.m. on Nov. 5.", "She left."],
    "See www.a.test/x.html or mail b@c.test. It costs $3.50, i.e. less.": ["See www.a.test/x.html or mail b@c.test.", "It costs $3.50, i.e. less."],
    'She said, "One. Two." Then he went. "No." That was all.': ['She said, "One. Two."', "Then he went.", '"No."', "That was all."],
    "Great fun 🎾 Come by! 😀 (No food.) Bye": ["Great fun 🎾", "Come by! 😀", "(No food.)", "Bye"],
    "Hours\n• Seniors: 7 a.m. sharp\n1) Fee $3; max. 2\n\nWe are open.": ["Hours", "• Seniors: 7 a.m. sharp", "1) Fee $3; max. 2", "We are open."],
    "This line is wrapped at about seventy characters because the text was a\nmail once. The next one\nis short.": ["This line is wrapped at about seventy characters because the text was a\nmail once.", "The next one\nis short."],
    "料金は2.5ドルです。「床は新しい。」と話しました。「本当？」と聞く！": ["料金は2.5ドルです。", "「床は新しい。」と話しました。", "「本当？」と聞く！"],
    "教练说：“新的。请换鞋。”前台开门。(No food.)Then we left.": ["教练说：“新的。请换鞋。”", "前台开门。", "(No food.)", "Then we left."],
    "真的吗？！“可以吗？”是问题。（请勿入内。）好": ["真的吗？！", "“可以吗？”是问题。", "（请勿入内。）", "好"],
    "«Новое», — сказала она. Мы в г. Ржев с 1987 г. Вход с ул. Лесной, д. 3.": ["«Новое», — сказала она.", "Мы в г. Ржев с 1987 г.", "Вход с ул. Лесной, д. 3."],
    "Am 3. Mai beginnt die 12. Saison. „Neu. Schnell“, sagt er. Siehe Abs. 7. Gut.": ["Am 3. Mai beginnt die 12. Saison.", "„Neu. Schnell“, sagt er.", "Siehe Abs. 7.", "Gut."],
    "¿De verdad?, dijo. Abre a las 9 a. m. ¿Sí? ¡Ya!": ["¿De verdad?, dijo.", "Abre a las 9 a. m.", "¿Sí?", "¡Ya!"],
    "Υπάρχουν μαθήματα; Η δρ. Ox ανοίγει.": ["Υπάρχουν μαθήματα;", "Η δρ. Ox ανοίγει."],
    "हम खुले हैं। कोर्ट सं. 9 नया है। क्या?": ["हम खुले हैं।", "कोर्ट सं. 9 नया है।", "क्या?"],
    "เปิดทุกวัน มีสนาม 8 คอร์ต กรุณามา": ["เปิดทุกวัน", "มีสนาม 8 คอร์ต", "กรุณามา"],
    "요금은 6.5달러입니다. 코치는 \"새것입니다. 신으세요.\"라고 말했습니다.": ["요금은 6.5달러입니다.", "코치는 \"새것입니다. 신으세요.\"라고 말했습니다."],
    "We won.Then ​we\r\nleft. pickleBuddies is new.": ["We won.", "Then ​we\r\nleft.", "pickleBuddies is new."],
    "": [], "  \n \t": [], None: [], "no mark": ["no mark"],
}


def test_sentences(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "doc_id long, text string")
    rows = sentences.split_sentences(df).orderBy("doc_id", "start_pos").collect()
    for i, (text, want) in enumerate(CASES.items()):
        mine = [r for r in rows if r.doc_id == i]
        assert [r.sentence for r in mine] == want
        assert all(text[r.start_pos : r.end_pos] == r.sentence for r in mine)


def test_a_very_long_text_is_cut_whole(spark):
    n = 20_000
    df = spark.createDataFrame([(1, "One more line here. " * n)], "doc_id long, text string")
    assert sentences.split_sentences(df).count() == n


def test_long_speech_is_one_sentence(spark):
    said = "It went on. " * 300
    rows = sentences.split_sentences(spark.createDataFrame([(1, f"She said, “{said.strip()}” Then he left."), (2, f"教练说：“{'新的。' * 300}”前台开门。")], "doc_id long, text string")).orderBy("doc_id", "start_pos").collect()
    assert len(said) > 3000 and [(len(r.sentence) > 800, r.sentence[-4:]) for r in rows] == [(True, "on.”"), (False, "eft."), (True, "新的。”"), (False, "台开门。")]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab A.!?\n\ue000\ue005\ue00a\ue010\ue012\ue0fe\ue0ff\uf8ff", max_size=40), min_size=1, max_size=20))
def test_private_use_characters_are_letters(texts):
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = str.maketrans({chr(c): "x" for c in [*range(0xE000, 0xF900)]})
    cuts = lambda d: sorted((r.doc_id, r.start_pos, r.end_pos) for r in sentences.split_sentences(d).collect())
    rows = sentences.split_sentences(df).collect()
    assert all(texts[r.doc_id][r.start_pos : r.end_pos] == r.sentence for r in rows)
    assert sorted((r.doc_id, r.start_pos, r.end_pos) for r in rows) == cuts(spark.createDataFrame([(i, t.translate(plain)) for i, t in enumerate(texts)], "doc_id long, text string"))


RANKS = None


def tokenizer():
    global RANKS
    if RANKS is None:
        path = pytest.importorskip("public_tokenizers") and tokens.vocabulary_path()
        RANKS = tokens.Tokenizer(tokens.load_ranks(path))
    return RANKS


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="ab cde'’éß的 \n\t12.,", max_size=80))
def test_ids_equal_the_library_and_decode_back(text):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    global LIB
    try:
        lib = LIB
    except NameError:
        lib = LIB = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
        lib.encode_special_tokens = True
    tok = tokenizer()
    ids = tok.encode(text)
    assert list(ids) == lib.encode(text, add_special_tokens=False).ids
    assert "".join(tok.decode(ids)) == text


def test_transducer_emits_before_the_end():
    tok = tokenizer()
    m = tok.machine
    s, sure = m.start, []
    for b in ("ab" * 200).encode():
        s, out = m.step(s, b)
        sure += out
    assert len(s.open) < 150 and sure and list(tok.encode("ab" * 200)) == [*sure, *s.final]


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40))
def test_utf8_machine_equals_the_library(data):
    u = tokens.Utf8()
    assert "".join(u.push(bytes((b,))) for b in data) + u.end() == data.decode("utf-8", "replace")


def test_null_and_empty_texts_have_no_ids(spark):
    pytest.importorskip("public_tokenizers")
    df = spark.createDataFrame([(1, None), (2, ""), (3, "hi <|endoftext|>"), (3, "hi")], "doc_id long, text string")
    rows = sorted((r.doc_id, len(r.ids)) for r in tokens.encode(df).collect())
    assert rows[:2] == [(1, 0), (2, 0)] and len(rows) == 4 and 50256 not in tokens.encode(df).filter("doc_id = 3").first().ids


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdef"), st.tuples(st.integers(0, 1000), st.floats(0, 1), st.integers(0, 5)), min_size=1), st.integers(0, 4000))
def test_water_filling(spec, total):
    sizes, targets, caps = ({s: v[k] for s, v in spec.items()} for k in range(3))
    given_ = mixing.water_fill(total, sizes, targets, caps)
    most = {s: sizes[s] * caps[s] for s in spec}
    able = sum(m for s, m in most.items() if targets[s] > 0)
    assert all(-1e-6 <= given_[s] <= most[s] + 1e-6 for s in spec)
    assert abs(sum(given_.values()) - min(total, able)) < 1e-6 * max(1, total)
    free = [s for s in spec if 0 < targets[s] and given_[s] < most[s] - 1e-6]
    ratio = [given_[s] / targets[s] for s in free if targets[s] > 1e-9]
    assert not ratio or max(ratio) - min(ratio) < 1e-5 * max(1, max(ratio))


def test_mix_keeps_to_its_plan(spark):
    rnd = random.Random(2)
    docs = [(i, rnd.choice(["a", "a", "a", "b", None, "z"]), rnd.randrange(1, 40)) for i in range(4000)]
    df = spark.createDataFrame(docs, "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 2), ("none", 0.1, 3), (None, 0.0, 1)], "source string, target_share double, max_repeats int")
    plan = mixing.plan(df, targets)
    mix = mixing.sample(df, plan).collect()
    got = {s: sum(r.n_tokens * r.copies for r in mix if r.source == s) for s in ("a", "b")}
    for s, _, cap, _, want in plan:
        assert abs(got.get(s, 0) - want) <= 40 and all(r.copies <= cap for r in mix if r.source == s)
    assert len({r.doc_id for r in mix}) == len(mix) and {r.source for r in mix} == {"a", "b"}
    again = mixing.sample(df.repartition(7), plan)
    assert sorted((r.doc_id, r.copies) for r in again.collect()) == sorted((r.doc_id, r.copies) for r in mix)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data here")
def test_whole_corpus_decodes_back(spark):
    out = tokens.round_trip(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert out.filter(~F.col("same")).count() == 0
