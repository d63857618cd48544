"""The reference's sample day files, retyped as literals.

Fixed values: four days of ten readings (SENSOR_1 .. SENSOR_10 in order),
and the clean CSV text produced from each.
"""

import json

RAW_DAYS = {
    "2026-04-08": ("2026-04-08 17:16:20", [91.71, 146.85, 64.24, 81.72, 26.6, 33.17, 115.25, 51.46, 28.22, 43.11]),
    "2026-04-09": ("2026-04-09 09:13:20", [108.9, 98.36, 79.61, 24.97, 78.47, 62.35, 102.13, 29.68, 91.66, 67.05]),
    "2026-04-10": ("2026-04-10 09:13:22", [60.37, 109.68, 75.3, 55.46, 33.5, 66.28, 59.89, 75.82, 59.64, 115.59]),
    "2026-04-12": ("2026-04-12 10:19:42", [85.54, 26.85, 114.57, 39.39, 22.28, 40.62, 144.21, 69.34, 144.46, 35.77]),
}

CLEAN_CSV = {
    "2026-04-08": """sensor_id,timestamp,temperature,status,temperature_f
SENSOR_1,2026-04-08 17:16:20,91.71,on,197.078
SENSOR_3,2026-04-08 17:16:20,64.24,on,147.632
SENSOR_4,2026-04-08 17:16:20,81.72,on,179.096
SENSOR_5,2026-04-08 17:16:20,26.6,on,79.88
SENSOR_6,2026-04-08 17:16:20,33.17,on,91.706
SENSOR_8,2026-04-08 17:16:20,51.46,on,124.628
SENSOR_9,2026-04-08 17:16:20,28.22,on,82.79599999999999
SENSOR_10,2026-04-08 17:16:20,43.11,on,109.598
""",
    "2026-04-09": """sensor_id,timestamp,temperature,status,temperature_f
SENSOR_2,2026-04-09 09:13:20,98.36,on,209.048
SENSOR_3,2026-04-09 09:13:20,79.61,on,175.298
SENSOR_4,2026-04-09 09:13:20,24.97,on,76.946
SENSOR_5,2026-04-09 09:13:20,78.47,on,173.246
SENSOR_6,2026-04-09 09:13:20,62.35,on,144.23
SENSOR_8,2026-04-09 09:13:20,29.68,on,85.424
SENSOR_9,2026-04-09 09:13:20,91.66,on,196.988
SENSOR_10,2026-04-09 09:13:20,67.05,on,152.69
""",
    "2026-04-10": """sensor_id,timestamp,temperature,status,temperature_f
SENSOR_1,2026-04-10 09:13:22,60.37,on,140.666
SENSOR_3,2026-04-10 09:13:22,75.3,on,167.54
SENSOR_4,2026-04-10 09:13:22,55.46,on,131.828
SENSOR_5,2026-04-10 09:13:22,33.5,on,92.3
SENSOR_6,2026-04-10 09:13:22,66.28,on,151.304
SENSOR_7,2026-04-10 09:13:22,59.89,on,139.802
SENSOR_8,2026-04-10 09:13:22,75.82,on,168.47599999999997
SENSOR_9,2026-04-10 09:13:22,59.64,on,139.352
""",
    "2026-04-12": """sensor_id,timestamp,temperature,status,temperature_f
SENSOR_1,2026-04-12 10:19:42,85.54,on,185.972
SENSOR_2,2026-04-12 10:19:42,26.85,on,80.33
SENSOR_4,2026-04-12 10:19:42,39.39,on,102.902
SENSOR_5,2026-04-12 10:19:42,22.28,on,72.104
SENSOR_6,2026-04-12 10:19:42,40.62,on,105.116
SENSOR_8,2026-04-12 10:19:42,69.34,on,156.812
SENSOR_10,2026-04-12 10:19:42,35.77,on,96.386
""",
}


def raw_records(day: str) -> list[dict]:
    ts, temps = RAW_DAYS[day]
    return [
        {"sensor_id": f"SENSOR_{i + 1}", "timestamp": ts, "temperature": t, "status": "on"}
        for i, t in enumerate(temps)
    ]


def write_day_file(folder, day: str) -> str:
    """One JSON array on one line, named by the run date, as the extract writes it."""
    path = folder / f"sensor_data_{day.replace('-', '')}.json"
    path.write_text(json.dumps(raw_records(day)))
    return str(path)
