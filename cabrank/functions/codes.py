"""Code lists.

Fixed values: codes, labels and bounds below must equal the published trip
data dictionary and the report labels, so they are written out as they are.
"""

TRIP_TYPES = ("yellow", "green")

PAYMENT_METHODS = {
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided Trip",
}

RATE_TYPES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}

DAY_NAMES = {
    1: "Sunday",
    2: "Monday",
    3: "Tuesday",
    4: "Wednesday",
    5: "Thursday",
    6: "Friday",
    7: "Saturday",
}

# Upper bounds are inclusive; longer trips fall into LONGEST_BAND.
DISTANCE_BANDS = {
    1: "0-1 miles",
    2: "1-2 miles",
    5: "2-5 miles",
    10: "5-10 miles",
    20: "10-20 miles",
}
LONGEST_BAND = "20+ miles"

# First and last hour of each part of the day, both inclusive.
DAY_PARTS = {
    "Morning Rush": (7, 9),
    "Daytime": (10, 16),
    "Evening Rush": (17, 19),
    "Evening": (20, 23),
}
NIGHT = "Late Night/Early Morning"

AIRPORT_WORDS = ("Airport", "JFK", "LaGuardia", "LGA", "Newark")
AIRPORT_WORDS_ANY_CASE = AIRPORT_WORDS + ("EWR",)

BAD_WEATHER = ("Rain", "Heavy Rain", "Snow")
