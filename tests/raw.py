"""The raw fixtures of FIXTURES.md, section 2, as files."""

from pathlib import Path

FLIGHT_HEADER = ("FL_DATE,OP_CARRIER,OP_CARRIER_FL_NUM,ORIGIN_AIRPORT_ID,DEST_AIRPORT_ID,CRS_DEP_TIME,"
                 "CRS_ELAPSED_TIME,ARR_DELAY_NEW,WEATHER_DELAY,NAS_DELAY,CANCELLED,DIVERTED,TAIL_NUM")
FLIGHTS = """\
2012-01-01,AA,1,10397,12892,0905,95.0,3.0,,,0.00,0.00,N1
2012-01-01,AA,2,10397,12892,5,60.0,,15.0,5.0,0.00,0.00,N1
2012-01-01,AA,3,10397,12892,0700,60.0,,,,1.00,0.00,N1
2012-01-01,AA,4,10397,12892,0700,60.0,,,,0.00,1.00,N1
2012-01-01,AA,5,10397,12892,0700,60.0,,,,,0.00,N1
2012-01-01,AA,6,10397,12892,2400,60.0,,,,0.00,0.00,N1
2012-01-01,AA,7,10397,12892,0600,,,,,0.00,0.00,N1
2012-01-01,AA,8,14771,10397,0800,65.0,,,,0.00,0.00,N1
2012-01-01,AA,1234.0,10397,12892,2100,95.0,,,,0.00,0.00,N1
"""
STATIONS = """\
AirportId,WBAN,TimeZone
10397,13874,-5
10397,13874,-5
10397,53863,-5
12892,23174,-8
14107,23183,-7
,12345,-5
"""
WEATHER_HEADER = ("WBAN,Date,Time,StationType,SkyCondition,SkyConditionFlag,Visibility,WeatherType,"
                  "DryBulbFarenheit,DryBulbCelsius,WetBulbFarenheit,DewPointFarenheit,RelativeHumidity,WindSpeed,"
                  "WindDirection,ValueForWindCharacter,PressureTendency,PressureChange,Altimeter,SeaLevelPressure,"
                  "StationPressure,HourlyPrecip")
# wban, date, time, sky, weather, dry bulb, wind direction, precipitation
WEATHER = [
    ("13874", "20120101", "0900", "FEW007 SCT014 OVC020CB", "-RA BR", "41", "270", " T"),  # w1
    ("13874", "20120101", "53", "CLR", "", "M", "VR ", "0.01"),  # w2
    ("53863", "20120101", "0900", "CLR", "", "42", "10", ""),  # w3
    ("13874", "20120101", "0905", "BKN350", "TSRA", "43", "20", ""),  # w4
    ("23174", "20120101", "1030", "CLR", "", "44", "30", ""),  # w5
    ("99999", "20120101", "0900", "CLR", "", "45", "40", ""),  # w6
    ("23183", "20120101", "0900", "CLR", "", "46", "50", ""),  # w7
    ("23174", "20111231", "1200", "CLR", "", "47", "60", ""),  # w8
]


def write_raw(root: Path) -> None:
    (root / "Flights").mkdir()
    (root / "Weather").mkdir()
    (root / "Flights" / "201201.csv").write_text(f"{FLIGHT_HEADER}\n{FLIGHTS}")
    late = FLIGHTS.splitlines()[0].replace("2012-01-01", "2012-02-01")
    (root / "Flights" / "201202.csv").write_text(f"{FLIGHT_HEADER}\n{late}\n")
    (root / "stations.csv").write_text(STATIONS)
    lines = [
        f"{w},{d},{t},0,{sky},,10.00,{kind},{dry},5,38,35,82,7,{wd},M,3,021,30.1,M,29.9,{rain}"
        for w, d, t, sky, kind, dry, wd, rain in WEATHER
    ]
    (root / "Weather" / "201201hourly.txt").write_text("\n".join([WEATHER_HEADER, *lines]) + "\n")
    (root / "Weather" / "201202hourly.txt").write_text(f"{WEATHER_HEADER}\n")
