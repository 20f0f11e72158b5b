"""Writing and reading of the library's own ``pyspark.ml`` stages (S3).

A stage is saved as its params and some plain values (metadata) and, where it has
any, data of its own in files next to them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.param import Params
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWriter


class StageWriter(MLWriter):
    """Params and additional plain values as metadata; data by ``save_data(path)``."""

    def __init__(self, instance: Params, extra: dict, save_data: Callable[[str], None]):
        super().__init__()
        self.instance, self.extra, self.save_data = instance, extra, save_data

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata=self.extra)
        self.save_data(path)


class StageReader(MLReader):
    """An instance by ``make(path, metadata, session)``, with the params saved."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make = make

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        instance = self.make(path, metadata, self.sparkSession)
        instance._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(instance, metadata)
        return instance
