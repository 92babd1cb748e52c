import pytest


@pytest.fixture(scope="session")
def _empty_embeddings(spark):
    """An empty table of embeddings beside the other empty ones."""
    def write(folder):
        spark.createDataFrame([], "vec_id long, embedding array<float>").write.mode("ignore").parquet(f"{folder}/embeddings.parquet")
    return write


@pytest.fixture(autouse=True)
def embeddings_of_empty_dir(request):
    if "empty_dir" in request.fixturenames:
        request.getfixturevalue("_empty_embeddings")(request.getfixturevalue("empty_dir"))
