import pytest

from clinlake.operators.enrich import call_endpoint, chain_summary, gate, response_checks

SCHEMA = "label string, http_method string, resource string, action string, data string"


def connect():
    def send(method, url, data):
        if "Boom" in url:
            raise TimeoutError("too slow")
        return {
            "response_status_code": 201 if method == "post" else 200, "response_url": url, "response_text": data,
            "response_headers": "{}", "response_time_seconds": 1.25,
        }

    return send


def test_row_semantics(spark):
    rows = [
        ("a", "get", "Patient", "id1", None), ("b", "POST", "Observation", "", '{"x":1}'), ("c", None, "Patient", None, None),
        ("d", "get", "", "x", None), ("e", "get", None, "x", None), ("f", "get", "Boom", "", None),
    ]
    out = {r.label: r for r in call_endpoint(spark.createDataFrame(rows, SCHEMA), "http://h/", connect).collect()}
    assert out["a"].response_url == "http://h/Patient/id1" and out["a"].response_text is None
    assert out["b"].response_status_code == 201 and out["b"].response_text == '{"x":1}'
    assert out["c"].response_status_code == 200 and out["c"].response_url == "http://h/Patient/"
    assert out["d"].error == out["e"].error == "error: resource required"
    assert out["f"].error == "too slow" and out["f"].response_status_code is None
    assert call_endpoint(spark.createDataFrame([], SCHEMA), "http://h/", connect).count() == 0


def test_gate(spark):
    rows = spark.createDataFrame([("g", 200, 0.5), ("p", 500, 0.5)], "label string, response_status_code int, response_time_seconds double")
    checks = response_checks(rows, "label", {"g": 200, "p": 201})
    assert {r.label: r.all_passed for r in checks.collect()} == {"g": True, "p": False}
    with pytest.raises(Exception, match="response checks failed"):
        gate(checks).collect()
    steps = spark.createDataFrame([("x", None), ("x", "y")], "a string, b string")
    assert {r.result for r in chain_summary(steps, {"a": "A", "b": "B"}).collect()} == {"B FAILED", "ALL STEPS PASSED"}
