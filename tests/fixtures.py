"""Hand-made inputs for the golden tests."""

from __future__ import annotations

import json

# --- fixed values: the public category list (id, title, assignable) --------
CATEGORY_ROWS = [
    (1, "Film & Animation", True),
    (2, "Autos & Vehicles", True),
    (10, "Music", True),
    (15, "Pets & Animals", True),
    (17, "Sports", True),
    (18, "Short Movies", False),
    (19, "Travel & Events", True),
    (20, "Gaming", True),
    (21, "Videoblogging", False),
    (22, "People & Blogs", True),
    (23, "Comedy", True),
    (24, "Entertainment", True),
    (25, "News & Politics", True),
    (26, "Howto & Style", True),
    (27, "Education", True),
    (28, "Science & Technology", True),
    (29, "Nonprofits & Activism", True),
    (30, "Movies", False),
    (31, "Anime/Animation", False),
    (32, "Action/Adventure", False),
    (33, "Classics", False),
    (34, "Comedy", False),
    (35, "Documentary", False),
    (36, "Drama", False),
    (37, "Family", False),
    (38, "Foreign", False),
    (39, "Horror", False),
    (40, "Sci-Fi/Fantasy", False),
    (41, "Thriller", False),
    (42, "Shorts", False),
    (43, "Shows", False),
    (44, "Trailers", False),
]
# --- end of fixed values ----------------------------------------------------


def category_json() -> str:
    """The list as a multi-line JSON document with CRLF line ends."""
    doc = {
        "kind": "categoryList",
        "etag": "test-etag",
        "items": [
            {
                "kind": "category",
                "etag": f"etag-{cid}",
                "id": str(cid),
                "snippet": {"channelId": "test-channel", "title": title, "assignable": assignable},
            }
            for cid, title, assignable in CATEGORY_ROWS
        ],
    }
    return json.dumps(doc, indent=2).replace("\n", "\r\n")


GOLDEN_CSV = """\
video_id,trending_date,title,channel_title,category_id,publish_time,tags,views,likes,dislikes,comment_count,thumbnail_link,comments_disabled,ratings_disabled,video_error_or_removed,description
v01,18.01.02,Plain,Chan A,10,2018-01-01T10:00:00.000Z,a|b,100,10,1,5,http://t/1,False,False,False,desc
v01,18.02.02,Plain,Chan A,10,2018-01-01T10:00:00.000Z,a|b,900,30,2,6,http://t/1,False,False,False,desc
v02,18.01.02,"Comma, twice",Chan A,10,2018-01-02T10:00:00.000Z,x,1000000,50,3,5,http://t/2,False,False,False,desc
v02,18.02.02,"Comma, twice",Chan A,10,2018-01-02T10:00:00.000Z,x,1000001,51,4,5,http://t/2,False,False,False,desc
v03,18.01.02,"Comma, once",Chan B,24,2017-12-31T23:59:59.000Z,x,999,7,0,5,http://t/3,False,False,False,"a ""quoted"" desc, with comma"
v04,18.01.02,Chan comma,"B, Inc",24,2018-02-28T00:00:00.000Z,x,50,5,0,5,http://t/4,False,False,False,desc
v05,18.01.02,No description,Chan C,25,2018-03-01T00:00:00.000Z,x,60,6,0,5,http://t/5,False,False,False,
v06,18.01.02,Big,Chan C,10,2018-01-05T00:00:00.000Z,x,2000000000,8,0,5,http://t/6,False,False,False,desc
v06,18.02.02,Big,Chan C,10,2018-01-05T00:00:00.000Z,x,2000000000,8,0,5,http://t/6,False,False,False,desc
v07,18.01.02,Bad views,Chan D,27,2018-01-06T00:00:00.000Z,x,n/a,8,0,5,http://t/7,False,False,False,desc
v07,18.02.02,Bad views,Chan D,27,2018-01-06T00:00:00.000Z,x,70,9,0,5,http://t/7,False,False,False,desc
v08,18.01.02,Bad date,Chan D,28,1/6/2018,x,80,9,0,5,http://t/8,False,False,False,desc
v09,18.01.02,Unknown category,Chan D,99,2018-01-07T00:00:00.000Z,x,90,9,0,5,http://t/9,False,False,False,desc
v10,18.01.02,Slash,Chan E,31,2018-01-08T00:00:00.000Z,x,91,9,0,5,http://t/10,False,False,False,desc
v11,18.01.02,Short row,Chan E,10
v12,18.01.02,Extra field,Chan E,10,2018-01-09T00:00:00.000Z,x,92,9,0,5,http://t/12,False,False,False,desc,extra
v13,18.01.02,Comedy 23,Chan F,23,2018-01-10T00:00:00.000Z,x,93,9,0,5,http://t/13,False,False,False,desc
v14,18.01.02,Not a category,Chan F,abc,2018-01-11T00:00:00.000Z,x,94,9,0,5,http://t/14,False,False,False,desc
"""
