"""Settings of a monthly vegetation-index run."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Mapping
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Config:
    """All parameters of a run; the defaults are those of the production run.

    ``clear_values`` are the mask values that count as clear sky, ``dn_sentinels`` the band values
    that mean no data in either band, ``dn_offset`` what is subtracted from both bands after (not
    on) ``offset_after``. ``oob`` says what a point outside a raster gets: ``null`` or, as
    ``clamp``, the pixel at the edge.
    """

    province: str = ""
    polygons: str = ""
    output_dir: str = ""
    tiles: str = ""
    archive_old: str = ""
    archive_new: str = ""
    archive_cutoff: dt.date = dt.date(2025, 7, 1)
    segment: str = ""
    date_start: dt.date = dt.date(2019, 1, 1)
    date_end: dt.date = dt.date(2026, 12, 31)
    nir_band: str = "08"
    red_band: str = "04"
    satellite: str = "B"
    grid_dir: str = ""
    grid_file: str = ""
    rebuild_points: bool = False
    offset_after: dt.date = dt.date(2022, 1, 25)
    dn_offset: int = 1000
    clear_values: tuple[int, ...] = (0,)
    dn_sentinels: tuple[int, ...] = (0, 65535)
    oob: str = "null"
    spacing: int = 10
    block: int = 256

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Config:
        """Settings from environment variables; the required ones fail fast.

        ``YEAR_START`` and ``YEAR_END`` are accepted as whole years where no date is given.
        """
        env = os.environ if env is None else env
        missing = [n for n in REQUIRED if not env.get(n)]
        if missing:
            raise ValueError(f"settings missing: {', '.join(missing)}")
        found: dict = {}
        kinds = {f.name: f.type for f in fields(cls)}
        for name, variable in VARIABLES.items():
            raw = env.get(variable, "").strip()
            if not raw:
                continue
            if kinds[name] == "dt.date":
                found[name] = dt.date.fromisoformat(raw)
            elif kinds[name] == "bool":
                found[name] = raw.lower() in ("1", "true", "yes")
            else:
                found[name] = raw
        if "date_start" not in found and env.get("YEAR_START"):
            found["date_start"] = dt.date(int(env["YEAR_START"]), 1, 1)
        if "date_end" not in found and env.get("YEAR_END"):
            found["date_end"] = dt.date(int(env["YEAR_END"]), 12, 31)
        found["province"] = found["province"].upper()
        return cls(**found)


# Names of the environment variables that users set today.
REQUIRED = ("PROVINCE", "GOLDEN_DURIAN_PATH", "OUTPUT_DIR")
VARIABLES = {
    "province": "PROVINCE",
    "polygons": "GOLDEN_DURIAN_PATH",
    "output_dir": "OUTPUT_DIR",
    "tiles": "SENTINEL2_TILE_PATH",
    "archive_old": "S2_FOLDER_OLD",
    "archive_new": "S2_FOLDER_NEW",
    "archive_cutoff": "S2_FOLDER_CUTOFF",
    "segment": "TREE",
    "date_start": "DATE_START",
    "date_end": "DATE_END",
    "nir_band": "BAND1",
    "red_band": "BAND2",
    "satellite": "SAT",
    "grid_dir": "GRID_POINTS_DIR",
    "grid_file": "GRID_POINTS_FILE",
    "rebuild_points": "FORCE_REBUILD_POINTS",
}
