from pyspark.sql import functions as F

from tasteloom.functions import scalars as C
from tasteloom.functions import text as TX
from tasteloom.functions import vectors as V


def test_clean_price(frame):
    given = [None, "", "none", "$49.99", "$10.00 - $20.00", "1,299.00", "call", ",", "12", "1e3", "1.5E-2", "-5", "nan", "1d"]
    want = [None, None, None, 49.99, 15.0, 1299.0, None, None, 12.0, 1000.0, 0.015, -5.0, None, 1.0]
    df = frame([(n, p) for n, p in enumerate(given)], "n int, p string")
    got = [r["v"] for r in df.select("n", C.clean_price("p").alias("v")).orderBy("n").collect()]
    assert got == want


def test_pick_image_both_layouts(frame):
    given = [
        '[{"thumb":"t","large":"","hi_res":"h"},{"large":"l2"}]', '{"large":["","l"],"thumb":["t"]}',
        '{"large":[],"hi_res":[null,"h"],"thumb":["t"]}', "[]", None, '[{"thumb":null},{"thumb":"t2"}]',
    ]
    df = frame([(n, p) for n, p in enumerate(given)], "n int, p string")
    got = [r["v"] for r in df.select("n", C.pick_image("p").alias("v")).orderBy("n").collect()]
    assert got == ["h", "l", "h", None, None, "t2"]


def test_leaf_category_and_rating(frame):
    df = frame([(["a", "b"], "m", "view"), ([], "m", "purchase"), (None, "m", "other")], "c array<string>, m string, e string")
    got = df.select(C.leaf_category("c", "m").alias("x"), C.event_rating("e").alias("r")).collect()
    assert [tuple(r) for r in got] == [("b", 3.0), ("m", 5.0), ("m", 3.0)]


def test_text_rules(frame):
    df = frame([("  Red   Ring ",)], "q string")
    assert df.select(TX.tokenize_query(F.col("q"))).first()[0] == ["red", "ring"]


def test_icon_order_and_labels(frame):
    df = frame([("Cables", "usb charger"), (None, "Gaming MOUSE"), (None, None)], "c string, t string")
    assert [r[0] for r in df.select(C.category_icon("c", "t")).collect()] == ["🔌", "🖱️", "📦"]
    assert df.select(C.model_label("Two-tower", 0.7)).first()[0] == "Two-tower + MMR(λ=0.7)"
    assert df.select(C.variety_to_lambda(F.lit(3.0))).first()[0] == 0.5


def test_zero_vector_passes(frame):
    df = frame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<double>")
    assert [list(r[0]) for r in df.select(V.l2_normalize("v")).collect()] == [[0.0, 0.0], [0.6, 0.8]]
    assert [r[0] for r in df.select(V.cosine("v", F.array(F.lit(1.0), F.lit(0.0)))).collect()] == [0.0, 0.6]
