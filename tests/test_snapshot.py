"""End to end: dump XML -> every stage of one snapshot, written by date."""

import os
import tempfile
from xml.sax.saxutils import quoteattr

from fixtures import BADGES, POSTS

from waitline.plans import snapshot
from waitline.sources.files import read_stage

NAMES = ("Id", "PostTypeId", "ParentId", "AcceptedAnswerId", "CreationDate", "OwnerUserId", "Tags", "Body", "Title")


def _xml(rows, names, root):
    out = [f"<{root}>"]
    for r in rows:
        attrs = []
        for n, v in zip(names, r):
            if v is None:
                continue
            if hasattr(v, "isoformat"):
                v = v.isoformat(timespec="milliseconds")
            attrs.append(f"{n}={quoteattr(str(v))}")
        out.append("  <row " + " ".join(attrs) + " />")
    out.append(f"</{root}>")
    return "\n".join(out)


def test_snapshot_end_to_end(spark):
    d = tempfile.mkdtemp(prefix="waitline-snap-")
    dump, out = os.path.join(d, "dump"), os.path.join(d, "out")
    os.makedirs(dump)
    with open(os.path.join(dump, "Posts.xml"), "w") as f:
        f.write(_xml(POSTS, NAMES, "posts"))
    with open(os.path.join(dump, "Badges.xml"), "w") as f:
        f.write(_xml(BADGES, ("Id", "UserId", "Name", "Date"), "badges"))
    paths = snapshot.run(spark, dump, out, "2016-01-01", min_support=1)

    def stage(name):
        return read_stage(spark, paths[name], "2016-01-01")

    content = {r.id: r.success for r in stage("content").collect()}
    assert content == {1: 1, 2: 0, 3: 1, 4: 0, 5: 1}  # 7: null body quarantined; 8: type 4
    week = {r.id: r.success for r in stage("content_week").collect()}
    assert week[4] == 1
    assert [r.id for r in stage("posts_quarantined").collect()] == [7]
    ext = {r.id: r for r in stage("posts_extracted").collect()}
    assert ext[1].paragraphs == "Why x fails?\nsecond" and ext[1].codes == "x\nprint(1)"
    assert ext[1].tags == " c#  .net " and ext[1].hascodes == 1
    assert {r.id: r.badges for r in stage("earned_badges").collect()} == {1: "Student Teacher"}
    anyb = {r.id: r.badges for r in stage("earned_badges_any").collect()}
    assert anyb[1] == "Student Teacher" and anyb[2] == "" and anyb[3] == ""
    bt = {r.id: (r.elapsed, r.badges) for r in stage("badge_time").collect()}
    assert bt == {1: (5, "Student Teacher"), 3: (1440, None)}
    ct = {r.id: (r.elapsed, r.badges) for r in stage("combined_time").collect()}
    assert ct == {1: (5, "Student Teacher")}
    comb = {r.id: r.badges for r in stage("combined").collect()}
    assert comb[2] == "" and comb[1] == "Student Teacher"
    sets = {tuple(r.items): r.freq for r in stage("tag_itemsets").collect()}
    assert sets[("a",)] == 1 and sets[("c#",)] == 1  # '<a><a>' is one basket item
