"""The embedding client against a stub service in this process."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from quire.operators import embed


@pytest.fixture
def service():
    """A service whose answer and accepted paths a test sets."""

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            payload = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            server.seen.append((self.path, payload, self.headers.get("Authorization")))
            answer = server.answer(self.path, payload)
            self.send_response(404 if answer is None else 200)
            self.end_headers()
            self.wfile.write(json.dumps(answer).encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    server.seen, server.answer = [], lambda path, payload: None
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield server
    server.shutdown()


def client(service, **kw):
    return embed.HttpEmbedder(f"http://127.0.0.1:{service.server_port}/", "m", **kw)


def test_forms_are_tried_in_order_and_remembered(service):
    service.answer = lambda path, payload: {"data": [{"embedding": [1, 2]} for _ in payload["input"]]} if path == "/v1/embeddings" and isinstance(payload["input"], list) else None
    c = client(service)
    assert c(["a", "b"]) == [[1.0, 2.0]] * 2 and [s[0] for s in service.seen] == ["/embed", "/v1/embeddings"]
    c(["a", "b"])
    assert [s[0] for s in service.seen][2:] == ["/v1/embeddings"]
    assert c(["one"]) == [[1.0, 2.0]] and service.seen[-1][1] == {"input": ["one"], "model": "m"}
    assert c([]) == []


def test_a_batch_answered_with_one_vector_goes_singly(service):
    service.answer = lambda path, payload: [0.5, 0.25] if path == "/embed" else None
    assert client(service)(["a", "b", "c"]) == [[0.5, 0.25]] * 3


def test_keys_and_failures(service):
    service.answer = lambda path, payload: {"embedding": [1.0]}
    client(service, api_key="REPLACE_ME")(["a"])
    client(service, api_key="k")(["a"])
    assert [s[2] for s in service.seen] == [None, "Bearer k"]
    service.answer = lambda path, payload: None
    with pytest.raises(Exception, match="404"):
        client(service)(["a"])
    with pytest.raises(ValueError, match="endpoint"):
        embed.HttpEmbedder("", "m")


@pytest.mark.parametrize(
    ("answer", "vectors"),
    [({"data": [{"embedding": [1]}, {"embedding": [2]}]}, [[1.0], [2.0]]), ({"embedding": [1, 2]}, [[1.0, 2.0]]), ({"embeddings": [[1], [2]]}, [[1.0], [2.0]]), ([1, 2], [[1.0, 2.0]]), ([[1], [2]], [[1.0], [2.0]]), ({}, []), ("x", []), (None, [])],
)
def test_answer_shapes(answer, vectors):
    assert embed.vectors_in(answer) == vectors


def test_embedding_a_table(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None), ("c", "x")], "point_id string, text string")
    out = {r.point_id: r.embedding for r in embed.embed(df, lambda: embed.HashEmbedder(40), 40, batch_size=2).collect()}
    assert len(out) == 3 and out["a"] == out["c"] != out["b"] and len(out["a"]) == 40
    assert abs(sum(x * x for x in out["a"]) - 1) < 1e-5
    with pytest.raises(Exception, match="expected 8"):
        embed.embed(df, lambda: embed.HashEmbedder(40), 8).collect()
