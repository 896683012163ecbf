"""Map script: 'key<TAB>value<TAB>quality' lines -> 'key<TAB>value' for good readings."""
import re
import sys

GOOD = re.compile(r"^[01459]$")

for line in sys.stdin:
    parts = line.rstrip("\n").split("\t")
    if len(parts) < 3:
        continue
    key, value, quality = parts[0], parts[1], parts[2]
    if value in ("", "\\N", "9999") or not GOOD.match(quality):
        continue
    sys.stdout.write(f"{key}\t{value}\n")
