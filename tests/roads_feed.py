"""A generated roads feed: four landing files with planted defects, and what
the layers must make of them."""

from __future__ import annotations

import os

HEADER = (
    "Road ID,Road category id,Road category,Region id,Region name,Total link length km,"
    "Total link length miles,All motor vehicles"
)
CODES = ["TM", "TA", "PA", "PM", "M"]
ROWS = [
    f"{20 * (region - 1) + 4 * k + i + 1},{k + 1},{code},{region},Region {region},{10 * region + k}.5,{6 * region + k}.25,{1000 * (region + k + i)}"
    for region in range(1, 7)
    for k, code in enumerate(CODES)
    for i in range(4)
]
REPEATED, BROKEN = ROWS[:25], [",1,TM,1,Region 1,1.5,1.0,10", ",2,TA,2,Region 2,2.5,1.5,20", "900,9,PA,3,Region 3,3.5,2.0,30"]
FILES = {
    "raw_roads1.csv": ROWS[:40],
    "raw_roads2.csv": ROWS[40:80],
    "raw_roads3.csv": ROWS[80:],
    "raw_roads4.csv": REPEATED + BROKEN,
}
N_BRONZE, N_SILVER, N_BROKEN = len(ROWS) + len(REPEATED), len(ROWS), len(BROKEN)


def text(name: str) -> str:
    return "\n".join([HEADER, *FILES[name]]) + "\n"


def land(folder: str, *names: str) -> None:
    os.makedirs(folder, exist_ok=True)
    for name in names or FILES:
        with open(os.path.join(folder, name), "w") as fh:
            fh.write(text(name))
