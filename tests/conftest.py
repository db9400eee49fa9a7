import datetime as dt
import os
import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path.insert(0, str(HERE.parent))
# Python workers unpickle functions that live in the test modules
os.environ["PYTHONPATH"] = os.pathsep.join([str(HERE.parent), str(HERE), os.environ.get("PYTHONPATH", "")])

from pressmonth.plans.lineage import drop_staged  # noqa: E402
from pressmonth.schemas import UPSTREAM  # noqa: E402
from pressmonth.session import local_session  # noqa: E402

NOW = dt.datetime(2024, 5, 1, 12)


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=4, memory="4g")
    yield session
    drop_staged(session)
    session.stop()


@pytest.fixture
def config(tmp_path):
    from pressmonth.sources.dictionary import load_keyword_config

    path = tmp_path / "keywords.yml"
    path.write_text(
        """
omitted_keywords: ["tapa impresa", "última hora", "Última   Hora"]
entries:
  - canonical: "Bahía Larga"
    type: place
    category: costa
    priority: 10
    aliases: ["Bahía Larga", "puerto de Bahía Larga"]
  - canonical: "El Remanso"
    type: place
    priority: 9
    aliases: ["El Remanso", "barrio El Remanso"]
  - canonical: "Corte de luz"
    priority: 8
    aliases: ["corte de luz", "falla general", "falta de suministro"]
  - canonical: "Marta Ibáñez"
    aliases: ["Ibáñez", "jueza Marta Ibáñez"]
  - canonical: "Tema cerrado"
    enabled: false
  - canonical: "  "
    type: topic
""",
        encoding="utf-8",
    )
    return load_keyword_config(path)


BODY_1 = (
    "Medio puerto de Bahía Larga pasó la noche a oscuras por el corte de luz. "
    "La cooperativa explicó la falta de suministro con un transformador quemado."
)
BODY_2 = "Nadie durmió tras la falla general en el barrio El Remanso. Los comercios tiraron lo que tenían en las heladeras."


def article(number, source, title, body, published, extracted=NOW, hash_=None, embedded=True):
    return (
        number, hash_ or f"hash_{number:03}", source, f"https://news.example/{number}", title, body, None,
        published, extracted, [0.1, 0.2] if embedded else None,
    )


@pytest.fixture
def upstream(spark):
    def make(*articles):
        return spark.createDataFrame(list(articles), UPSTREAM)

    return make


@pytest.fixture
def two_articles():
    return (
        article(1, "Fuente A", "Sigue el corte de luz en Bahía Larga", BODY_1, dt.datetime(2024, 3, 15, 10)),
        article(2, "Fuente B", "Quejas en El Remanso por la falla general", BODY_2, dt.datetime(2024, 3, 20, 12)),
    )
