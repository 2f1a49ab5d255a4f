"""Small inputs with known results.

Fixed values: they must equal the inputs whose results are known.  In SCORES names of
persons are replaced by p1 to p6.
"""

from millrace.operators.parse import with_event_time
from millrace.sources import generated
from pyspark.sql import types as T

BASE_DATE = "2020-12-16"

CLICKS_A = [
    ("marry", "12:30:30", "/home.html"),
    ("Bob", "12:45:30", "/cart.html"),
    ("Liz", "13:15:30", "/prod.html"),
    ("marry", "13:30:30", "/home.html"),
    ("Bob", "14:45:30", "/cart.html"),
    ("Liz", "14:15:30", "/prod.html"),
]
CLICKS_B = [
    ("marry", "12:30:30", "/home.html"),
    ("Bob", "12:45:30", "/cart.html"),
    ("Liz", "13:15:30", "/prod.html"),
    ("marry", "12:30:30", "/home.html"),
    ("Bob", "12:45:30", "/cart.html"),
    ("Liz", "13:15:30", "/prod.html"),
]

CLICK_LINES = [
    "marry 12:30:30 /home.html",
    "Bob 12:40:30 /cart.html",
    "marry 12:45:30 /prod.html?id=1",
    "marry 12:55:30 /prod.html?id=1",
    "Bob 13:05:30 /prod.html?id=1",
    "Liz 13:45:30 /prod.html?id=1",
    "Liz 13:55:30 /prod.html?id=2",
    "marry 14:30:30 /home.html",
    "Liz 14:25:30 /prod.html?id=3",
    "Bob 14:05:30 /prod.html?id=1",
    "Bob 14:35:30 /home.html",
]

PROSE = [
    "To be, or not to be,--that is the question:--",
    "Whether 'tis nobler in the mind to suffer",
    "The slings and arrows of outrageous fortune",
    "Or to take arms against a sea of troubles,",
]

PRICES = (
    "2.02,Euro,2019-12-12 00:00:01.001001\n"
    "1.11,US Dollar,2019-12-12 00:00:02.002001\n"
    "50,Yen,2019-12-12 00:00:04.004001\n"
    "3.1,Euro,2019-12-12 00:00:05.005001\n"
    "5.33,US Dollar,2019-12-12 00:00:06.006001"
)

SCORES = [
    ("class1", "p1", 100),
    ("class1", "p2", 78),
    ("class1", "p3", 99),
    ("class2", "p4", 81),
    ("class2", "p5", 59),
    ("class2", "p6", 97),
]

PATTERN = [
    (1, "barfoo", 1.0),
    (2, "start", 2.0),
    (3, "foobar", 3.0),
    (4, "foo", 4.0),
    (5, "middle", 5.0),
    (42, "42", 42.0),
    (8, "end", 1.0),
]

RAW_CLICK = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("user", "time", "url")]
)
SCORE = T.StructType(
    [
        T.StructField("grp", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("score", T.LongType()),
    ]
)
NAMED_EVENT = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("foo", T.DoubleType()),
    ]
)
LINE = T.StructType([T.StructField("value", T.StringType())])


def clicks(spark, rows):
    raw = generated.rows(spark, rows, RAW_CLICK, seq="seq")
    return with_event_time(raw, BASE_DATE)


def lines(spark, texts):
    return generated.rows(spark, [(text,) for text in texts], LINE, seq="seq")


def scores(spark):
    return generated.rows(spark, SCORES, SCORE, seq="seq")


def events(spark, names):
    rows = [(position, name, 0.0) for position, name in enumerate(names)]
    return generated.rows(spark, rows, NAMED_EVENT, seq="seq")


def prices_file(tmp_path):
    folder = tmp_path / "prices"
    folder.mkdir()
    (folder / "part.csv").write_text(PRICES)
    return str(folder)


def tuples(df, *names):
    shown = df.select(*names) if names else df
    return sorted((tuple(row) for row in shown.collect()), key=repr)
