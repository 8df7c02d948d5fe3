"""Tasks carry the package with them: executors cannot import it."""

import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle

from pixelweave.functions import arrow, labels, storage, tensors
from pixelweave.learning import scoring
from pixelweave.operators import images, joins, layout, numbering
from pixelweave.plans import bindings, images as image_plans
from pixelweave.sinks import image_files
from pixelweave.sources import files

CARRIED = [
    arrow.map_block, storage.Storage, tensors.bilinear, scoring.softmax, images.resized_pixels,
    image_files.write_image_files, files.with_contents, image_plans.png,
    labels, bindings, joins, layout, numbering,
]


@pytest.mark.parametrize("item", CARRIED, ids=lambda item: item.__name__)
def test_unpickles_without_the_package(item, tmp_path):
    payload = tmp_path / "item"
    payload.write_bytes(cloudpickle.dumps(item))
    code = "import pickle, sys; pickle.load(open(sys.argv[1], 'rb'))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code, str(payload)], cwd=tmp_path, env=env, capture_output=True)
    assert run.returncode == 0, run.stderr.decode()[-800:]
