import base64
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from eventloom import vocab
from eventloom.functions import basic_auth
from eventloom.operators import fixity
from eventloom.streaming import delivery

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Rejects:
    """Never accepts some payloads, takes others at the third try."""

    def __init__(self):
        self.calls = {}

    def __call__(self, payload):
        self.calls[payload] = self.calls.get(payload, 0) + 1
        if "never" in payload or ("third" in payload and self.calls[payload] < 3):
            raise OSError("down")


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "message string")


def test_redelivery_counts(spark):
    out = delivery.with_retry(messages(spark, "never", "third", "ok"), Rejects(), "message", 4)
    found = {r.message: (r.attempts, r.error) for r in out.collect()}
    assert found == {"never": (5, "OSError: down"), "third": (3, None), "ok": (1, None)}


def test_default_number_of_attempts(spark):
    out = delivery.with_retry(messages(spark, "never"), Rejects())
    assert out.first().attempts == 11


def test_outcome_and_dead_letters(spark, tmp_path):
    target = str(tmp_path)
    for _ in range(2):  # a replayed batch replaces its own results
        delivery.forward(messages(spark, "never", "ok"), target, Rejects(), max_redeliveries=1)
    letters = delivery.read_dead_letters(spark, f"{target}/dead").collect()
    assert [(r.payload, r.attempts, r.service) for r in letters] == [("never", 2, "forward")]
    assert letters[0].failed_at is not None


def test_nothing_is_sent_without_an_endpoint(spark, tmp_path):
    delivery.forward(messages(spark, "a", "b"), str(tmp_path))
    letters = delivery.read_dead_letters(spark, f"{tmp_path}/dead").collect()
    assert {(r.payload, r.error, r.attempts) for r in letters} == {
        ("a", vocab.NO_ENDPOINT, 0), ("b", vocab.NO_ENDPOINT, 0),
    }


def test_folder_endpoint(spark, tmp_path):
    delivery.forward(messages(spark, '{"id":"a"}'), f"{tmp_path}/t", endpoint=f"{tmp_path}/out")
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{tmp_path}/out")
    assert [r.value for r in lines.collect()] == ['{"id":"a"}']


def test_credentials_travel_without_the_connection():
    post = delivery.HttpPost("http://localhost/x", "user", "secret")
    value = "Basic " + base64.b64encode(b"user:secret").decode()
    assert post.headers["Authorization"] == value
    post.connection = object()
    assert cloudpickle.loads(cloudpickle.dumps(post)).connection is None
    for blank in (None, "", "  "):
        assert delivery.HttpPost("http://localhost/x", blank, "p").headers.keys() == {"Content-Type"}


class Answers:
    """A connection that answers as told and counts how often it was made."""

    made = 0
    codes = []

    def __init__(self, *_args, **_kwargs):
        Answers.made += 1

    def request(self, *_args):
        self.status = Answers.codes.pop(0)
        if self.status is None:
            raise OSError("reset")

    def getresponse(self):
        self.reason = "told"
        return self

    def read(self):
        return b""

    def close(self):
        pass


def test_a_connection_is_kept_until_it_fails(monkeypatch):
    monkeypatch.setattr(delivery.http.client, "HTTPConnection", Answers)
    post, Answers.codes, Answers.made = delivery.HttpPost("http://localhost/x?y=1"), [200, 204, None, 200, 503], 0
    post("a")
    post("b")
    for error in (OSError, None, OSError):
        try:
            post("c")
            assert error is None
        except OSError as problem:
            assert error is OSError and ("reset" in str(problem) or "503" in str(problem))
    assert Answers.made == 2


def test_parts_after_a_failed_one_are_not_sent(spark):
    rows = spark.createDataFrame(
        [("u", 0, "ok"), ("u", 1, "never"), ("u", 2, "ok"), ("v", 0, "ok"), ("v", 1, "ok")],
        "uri string, part int, message string",
    )
    out = delivery.with_retry(rows, Rejects(), "message", 1, group="uri", order="part").collect()
    found = {(r.uri, r.part): (r.attempts, r.error) for r in out}
    assert found[("u", 1)] == (2, "OSError: down") and found[("u", 2)] == (0, "an earlier part failed")
    assert [found[k] for k in (("u", 0), ("v", 0), ("v", 1))] == [(1, None)] * 3


def test_basic_auth_column(spark):
    df = spark.createDataFrame([("user", "secret"), (" ", "x"), (None, "x")], "u string, p string")
    value = "Basic " + base64.b64encode(b"user:secret").decode()
    assert [r[0] for r in df.select(basic_auth("u", "p")).collect()] == [value, None, None]


def test_fixity_sinks(spark, tmp_path):
    results = spark.createDataFrame([("a", "SUCCESS"), ("b", "FAILURE"), ("c", None)], "uri string, outcome string")
    seen = {}

    def keep(name):
        return lambda df, batch_id: seen.setdefault(name, sorted(r.uri for r in df.collect()))

    delivery.fixity_sinks(results, f"{tmp_path}/log", on_success=keep("good"))
    log = spark.read.option("recursiveFileLookup", "true").json(f"{tmp_path}/log")
    assert seen == {"good": ["a"]} and {r.uri for r in log.select("uri").collect()} == {"b", "c"}
    delivery.fixity_sinks(results, f"{tmp_path}/none", on_failure=keep("bad"))
    assert seen["bad"] == ["b", "c"] and not (tmp_path / "none").exists()
    assert fixity.split_fixity(results.filter(F.lit(False)))[0].count() == 0
