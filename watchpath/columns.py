"""Column names of the timeline row and of the attributed result.

These names are the published output schema, so they are kept verbatim.
"""

ACCOUNT = "Adobe_Tracking_ID"
DAY = "Adobe_Date"
TIME = "Adobe_Timestamp"
PLAYER_EVENT = "Player_Event"
DETAILS = "Binge_Details"
START_TYPE = "Video_Start_Type"
DEVICE = "device_name"
FEEDER = "Feeder_Video"
FEEDER_ID = "Feeder_Video_Id"
TITLE = "Display_Name"
VIDEO_ID = "video_id"
SECONDS = "num_seconds_played_no_ads"
LAST_ACTION = "Last_Actions"
RUN = "grp"
EPISODE_TIME = "Episode_Time"
WATCH_TIME = "New_Watch_Time"

# the 12 columns every timeline row carries, clicks and plays alike
TIMELINE = [
    ACCOUNT, DAY, TIME, PLAYER_EVENT, DETAILS, START_TYPE, DEVICE,
    FEEDER, FEEDER_ID, TITLE, VIDEO_ID, SECONDS,
]

# the attributed result (stored, then re-read by the share reports)
ATTRIBUTED = [
    ACCOUNT, DAY, TIME, LAST_ACTION, START_TYPE, DEVICE,
    FEEDER, FEEDER_ID, TITLE, VIDEO_ID, SECONDS, WATCH_TIME,
]
