"""Faults in dimension histories, each planted once."""

from stratamart.model import CUSTOMERS, DIMENSIONS
from stratamart.operators.history_check import RULES, history_faults, marked_versions
from tests.frames import day

SPEC = DIMENSIONS[CUSTOMERS]
OPEN = "9999-12-31"


def dimension(spark, rows):
    return spark.createDataFrame(
        [(k, sk, None if a is None else day(a), None if b is None else day(b), active) for k, sk, a, b, active in rows],
        "ClienteID bigint, SK_Cliente bigint, data_inicio date, data_fim date, registro_ativo int",
    )


def broken(spark, rows):
    marked = marked_versions(dimension(spark, rows), SPEC).collect()
    return {(r.SK_Cliente, rule) for r in marked for rule in RULES if r[rule]}


def test_sound_histories_have_no_faults(spark):
    # A third of all versions are of one key.
    rows = [(1, i, f"20{i:02d}-01-01", f"20{i + 1:02d}-01-01", 0) for i in range(1, 40)] + [(1, 40, "2040-01-01", OPEN, 1)]
    rows += [(k, 100 + k, "2020-01-01", OPEN, 1) for k in range(2, 80)]
    assert broken(spark, rows) == set()
    assert {r.linhas for r in history_faults(dimension(spark, rows), SPEC).collect()} == {0}


def test_every_planted_fault_is_found_and_no_other(spark):
    rows = [
        (1, 1, "2020-01-01", "2020-06-01", 0), (1, 2, "2020-05-01", OPEN, 1),
        (2, 3, "2020-01-01", "2020-06-01", 0), (2, 4, "2020-07-01", OPEN, 1),
        (3, 5, "2020-01-01", "2020-06-01", 1), (3, 6, "2020-06-01", OPEN, 1),
        (4, 7, "2020-01-01", "2020-01-01", 0), (4, 8, "2020-01-01", OPEN, 1),
        (5, 9, "2020-01-01", OPEN, 0),
        (6, 10, "2020-01-01", "2020-06-01", 0), (6, 10, "2020-06-01", OPEN, 1),
        (None, 11, "2020-01-01", OPEN, 1),
        (7, None, "2020-01-01", OPEN, 1),
        (8, 12, None, OPEN, 1),
        # A long version hides the gap behind a short one that lies inside it.
        (9, 13, "2020-01-01", "2020-12-01", 0), (9, 14, "2020-02-01", "2020-03-01", 0), (9, 15, "2020-12-01", OPEN, 1),
    ]
    assert broken(spark, rows) == {
        (2, "sobreposicao"), (4, "lacuna"), (5, "fim_sem_sucessor"), (6, "dois_ativos"), (7, "intervalo_vazio"),
        (9, "fim_sem_sucessor"), (10, "sk_repetida"), (11, "sem_chave"), (None, "sk_repetida"), (12, "intervalo_vazio"),
        (14, "sobreposicao"),
    }
    counts = {r.regra: r.linhas for r in history_faults(dimension(spark, rows), SPEC).collect()}
    assert list(counts) == list(RULES) and counts["sk_repetida"] == 3 and counts["sobreposicao"] == 2


def test_empty_dimension(spark):
    assert {r.linhas for r in history_faults(dimension(spark, []), SPEC).collect()} == {0}
