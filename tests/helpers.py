"""What several test modules need; imported by name, unlike conftest."""

import json
import os

SF_SMALL = "/root/testdata/sf0.001"


def write_lines(path: str, docs: list[dict], name: str = "part-0.json") -> str:
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for d in docs:
            f.write(json.dumps(d) + "\n")
    return path
