"""English stems against published vocabulary, and P20 from text to tokens."""

from tweetlake.functions.stem import stem, stem_table
from tweetlake.operators.normalise import stemmed_tokens

# Word and stem: from the published sample vocabulary of the algorithm, and one or more for every rule.
KNOWN = """consign consign consigned consign consigning consign consignment consign consist consist consistency consist
consistently consist consolation consol consolatory consolatori consolingly consol consolidate consolid conspicuous conspicu
conspicuously conspicu conspiracy conspiraci conspirators conspir constables constabl constancy constanc constant constant
knack knack knackeries knackeri knaves knave knavish knavish kneading knead knee knee kneeled kneel knew knew knife knife
knightly knight knitted knit knives knive knocked knock flying fli early earli dying die say say by by enjoy enjoy happy happi
generic generic generate generat communism communism hopping hop hoping hope agreed agre feed feed ties tie cries cri gas gas
this this kiwis kiwi boyish boyish national nation rational ration relational relat rationalize ration apology apolog
analogy analog skis ski proceed proceed succeeding succeed roll roll shed shed vileness vile caresses caress ponies poni
plastered plaster motoring motor sing sing conflated conflat troubled troubl sized size falling fall hissing hiss failing fail
filing file sky sky conditional condit hesitancy hesit digitizer digit differently differ vietnamization vietnam predication predic
operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous formality formal sensitivity sensit
sensibility sensibl triplicate triplic formative format formalize formal electricity electr electrical electr hopeful hope
goodness good revival reviv allowance allow inference infer airliner airlin adjustable adjust irritant irrit replacement replac
dependent depend adoption adopt effective effect probate probat rate rate cease ceas oscillators oscil families famili
resources resourc employee employe aussie aussi at at yes yes youth youth""".split()


def test_published_vocabulary(spark):
    df = spark.createDataFrame(list(zip(KNOWN[::2], KNOWN[1::2])), "token string, want string")
    assert [tuple(r) for r in df.withColumn("stem", stem("token")).where("stem <> want").collect()] == []


def test_stem_table_has_each_word_once(spark):
    df = spark.createDataFrame([("cats", 1), ("cats", 2), ("cat", 3)], "token string, stem int")
    assert sorted(tuple(r) for r in stem_table(df).collect()) == [("cat", "cat"), ("cats", "cat")]


def test_normalised_and_stemmed(spark):
    """One copy of a stem in the order of first appearance; digits, single letters and stop words go."""
    rows = [(1, "Outrage outraged OUTRAGES families the x1 a"), (2, None), (3, ""), (4, "The of"), (5, "@user_1 running, RUN runs! Éa"),
            (2**53 + 1, "Flying flies")]
    got = {r.k: r.tokens for r in stemmed_tokens(spark.createDataFrame(rows, "k long, t string"), "k", "t").collect()}
    assert got == {1: ["outrag", "famili"], 2: [], 3: [], 4: [], 5: ["run"], 2**53 + 1: ["fli"]}
    salted = stemmed_tokens(spark.createDataFrame(rows, "k long, t string"), "k", "t", hot_key_share=0.2)
    assert {r.k: r.tokens for r in salted.collect()} == got


def test_tweet_shaped_texts(spark):
    """Mentions with digits or underscores vanish, links leave their letters, entities and contractions theirs."""
    rows = [("a", "@Some_One why don't these parties matter? &amp; LOL http://t.co/aB3dEf #parties"),
            ("b", "We aren't hopping early... hopeful runners hope it's flying")]
    got = {r.k: r.tokens for r in stemmed_tokens(spark.createDataFrame(rows, "k string, t string"), "k", "t").collect()}
    assert got == {"a": ["don", "parti", "matter", "amp", "lol", "http"], "b": ["aren", "hop", "earli", "hope", "runner", "fli"]}
