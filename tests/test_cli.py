import re

import folio
from folio.__main__ import main


def test_cli_lists_every_key(capsys):
    assert main(["list"]) == 0
    keys = capsys.readouterr().out.split()
    library = [k for k in keys if k != "pipeline" and not re.match(r"op\d+_", k)]
    assert len(library) == 112 and "q8_3_top3_per_genre" in keys


def test_package_exports():
    assert callable(folio.build_session) and callable(folio.library_for)
    assert "q3_1_active_members" in folio.REPORTS
