"""Python code sent to workers must not need this package there."""

import pickle

from pyspark import cloudpickle

from tagmill.functions.hashing import folder
from tagmill.operators import geo, simhash


def test_functions_travel_without_the_package(monkeypatch):
    for function in (folder(64), folder(256, "1"), simhash._partial_sums(128, "1a"), geo._divide(64, 2, 4, -96)):
        payload = cloudpickle.dumps(function)
        seen = []

        class Reader(pickle.Unpickler):
            def find_class(self, module, name):
                seen.append(module)
                return super().find_class(module, name)

        import io

        Reader(io.BytesIO(payload)).load()
        assert not [m for m in seen if m.startswith("tagmill")]
