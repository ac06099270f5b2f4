"""Vocabulary of log messages: which identifiers are kept as words.  Pluggable; fingerprint values depend on it."""

from __future__ import annotations

from collections.abc import Collection

#: Words by theme.  Our own list: common English and the vocabulary of software logs.
_GENERAL = """
a able about above accept access account across action active add after again against age ago agree ahead all allow almost alone along already also
alternate although always am among amount an and another answer any anyone anything appear apply are area argue arm around arrive art as ask assume at
attack attempt attention available average avoid away back bad bar base be because become been before begin behind being believe below best better
between beyond big bit black block blue board body book both bottom box bring brought build built business busy but by call called came can cannot car
card care carry case catch cause center central certain chance change changed changing character charge check child choice choose circle city class clean
clear close closed cloud code cold collect color come comes coming common company compare complete completed condition consider contain contains content
continue control copy correct cost could count country couple course cover create created creating cross current currently cut daily dark data date day
days dead deal decide deep default define degree depend describe description design detail details develop did die difference different difficult direct
direction directly do does doing done door double down draw drive drop dropped due during each early easy edge effect either element else empty end ended
energy enough enter entire entry equal even event events ever every everything exact example except exist exists expect expected explain extra eye face
fact fail failed failing fails failure fall false family far fast father feel few field figure file files fill final finally find fine finish finished
fire first fit five fix flag flow follow followed following foo food for force foreign form format found four free frequent friend from front full
function further future game gave general get gets getting give given go goes going gone good got great green group grow guess had half hand happen
happened hard has have having he head health healthy hear heart heavy held hello help her here high him his hit hold home hope hot hour hours house how
however huge human hundred i idea if image important in include included including increase indeed index inside instead interest into invalid is issue it
item items its itself job join joined just keep kept key keys kind knew know known large last late later lead least leave left length less let level life
light like likely limit line lines list little live local long look lost lot loud love low machine made main major make makes making man manage many map
mark match matched matching matter max maximum may maybe me mean means measure medium meet member memory men message messages middle might min mind
minimum minute minutes miss missing mode model modern moment money month more morning most mother move moved much multiple must my name named names nature
near need needed needs negative never new next nice night nine no none normal normally not note nothing notice now number numbers object occur occurred of
off offer office often oh oil ok okay old on once one only onto open opened opening operation option options or order ordinary origin original other
others our out output outside over own owner page pair paper parent part parts party pass passed past path pattern pay people per perfect perform perhaps
period person phone place plan plane play please point points policy poor position positive possible power prepare present press pretty prevent previous
price primary print private probably problem produce product program project proper protect prove provide provided public pull purchase purpose push put
question queue quick quickly quite quiet raise ran range rate rather raw reach reached read reading ready real reason receive received recent record red
reduce reference region regular related release remain remaining remember remote remove removed repeat repeated replace report request require required
rest result results retry return returned returns right ring risk room root round rule rules run running safe said same save saved saw say scale school
scope score screen search second seconds section security see seem seen select self send sent separate series serious serve service set sets setting
seven several shall shape share she short should show shown side sign signal similar simple simply since single site six size skip skipped slow slowly
small smaller so some someone something soon sort sound source south space special specific speed stable stand standard start started starting starts
state status stay step still stop stopped stopping store stored story stream street string strong structure study subject success successful successfully
such sum supply support sure system table take taken takes talk target task tell ten term test than thank that the their them then there these they thing
things think third this those though thought thousand three through thus time times title to today together token told too took top total touch toward
track traffic travel tree tried trouble true try trying turn two type types under understand unit united unknown until unused up update updated updating
upon us usage use used user users uses using usual usually valid value values various version very via view visit wait waited waiting walk wall want
warm was watch water way we weak week weight welcome well went were west what when where whether which while white who whole whose why wide will window
wish with within without word words work worked worker working works world would write writing written wrong wrote year years yellow yes yesterday yet you
young your zero
"""
_SOFTWARE = """
abort aborted acknowledge acquire acquired adapter admin address agent alarm alert alerts alias allocate allocated allocation anonymous api app append
application apps archive argument arguments array assert assertion assign assigned async attach attached attribute attributes audit auth authenticate
authenticated authentication author authority authorization authorized auto backend backoff backup balance balancer bandwidth batch beacon bean begin
binary bind binding boolean boot bootstrap boundary branch breaker bridge broadcast broken broker browser bucket buffer buffers bug bundle byte bytes
cache cached caches callback cancel canceled cancelled capacity capture catalog certificate chain channel charset checkpoint checksum chunk cipher circuit
cleanup cleared client clients clock clone cluster clusters codec collection collector column columns command commands commit committed compact compaction
compile compiled component compress compressed compression compute concurrent config configuration configure configured confirm conflict connect connected
connecting connection connections console constant constraint constructor consume consumer consumers container containers context controller convert
cookie coordinator core corrupt corrupted counter cpu crash crashed credential credentials cron cursor cycle daemon dashboard database datacenter datanode
dataset deadline deadlock debug decode decoded decoder decrypt delay delayed delete deleted deleting delivery denied deny dependency deploy deployed
deployment deprecated deserialize destination destroy destroyed detached detect detected device diagnostic dictionary digest directory disable disabled
disconnect disconnected discover discovery disk dispatch dispatcher display distributed dns docker document domain download downloaded downstream drain
driver dump duplicate duration dynamic election emit emitter enable enabled encode encoded encoder encoding encrypt encrypted encryption endpoint endpoints
engine enqueue ensure environment error errors evaluate evict evicted eviction exception exceeded execute executed executing execution executor exhausted
exit exited expire expired expires expiry export exported exporter expression extension external extract fatal fault feature features fetch fetched
filesystem filter filtered filters fingerprint firewall flush flushed folder fork forward forwarded fragment frame framework frontend garbage gateway
gauge generate generated generation global grant granted graph group guest handle handled handler handlers handshake hash header headers heap heartbeat
histogram history hook host hostname hosts http https icon identifier identity idle ignore ignored ignoring immediate implementation import imported
inactive inbound incoming incomplete increment indexed indexer indices info infrastructure ingest ingester ingress init initial initialization initialize
initialized initializing inject input insert inserted inspect install installed instance instances integer integration integrity interceptor interface
internal interpreter interrupt interrupted interval invalidate invoke invoked isolation iteration iterator java javascript json kafka kernel kill killed
kubernetes label labels lag latency latest launch launched layer layout leader lease leak library license listen listener listening load loaded loader
loading lock locked locks log logged logger logging login logout logs lookup loop mail maintenance malformed manager mapper mapping marker mask master
maintenance merge merged metadata method metric metrics micro middleware migrate migration millis minor mirror mismatch mobile mock module modules monitor
monitoring mount mounted multi mutex namespace native navigate negotiate network networks node nodes notification notify null offline offset online
operator optimize optimizer orchestrator orphan outbound outgoing overflow override overhead package packet packets panic parameter parameters parse parsed
parser parsing partial partition partitions password patch paths pause paused payload payment peer peers pending percent performance permission permissions
persist persistent ping pipeline pipelines plugin plugins pod pods poll polling pool pools port ports post preferred prefix priority probe process processed
processes processing processor produce producer producers profile progress prometheus promote prompt properties property protocol provider provision proxy
publish published publisher purge python quarantine queries query quorum quota random rebalance reboot rebuild receiver recipient reconnect reconnecting
recover recovered recovery redirect redis reduce refresh refused register registered registration registry reject rejected reload reloaded remaining
render renew repair replica replicas replicate replication repository requests reset resize resolve resolved resolver resource resources respond response
responses restart restarted restarting restore restored resume resumed retention retries retrieve retrieved retrying revision revoke role rollback rolled
rollup rotate route router routes routing row rows runtime sample sampler sandbox scan scanned scanner schedule scheduled scheduler schema script secret
secrets segment selector semaphore sender sending sequence serialize serialized server servers session sessions severity shard shards shell shutdown
shutting sidecar signature sink skew sleep slot snapshot socket software span spans spawn splitter sql stack stage stale standby startup statement static
statistics stats storage streaming submit submitted subnet subscribe subscriber subscription suffix summary suspend suspended suspicious swap switch sync
synchronize synchronized syntax telemetry template tenant terminate terminated terminating thread threads threshold throttle throttled throughput ticket
tid timeout timer timestamp tokens tombstone topic topics topology trace traces trailing transaction transactions transfer transform transient transition
transport trigger triggered truncate truncated trust tunnel unable unauthorized unavailable unbound undefined unexpected unhandled unhealthy unique unlock
unmount unregistered unreachable unsupported update upgrade upgraded upload uploaded upstream uptime uri url username utility utilization uuid vacuum
validate validated validation variable vector verification verified verify violation virtual volume volumes vulnerability wakeup warehouse warn warning
warnings watchdog watcher web webhook wildcard workers workflow workload workspace wrapper writer yaml zone
"""
_NAMES = "alice bob john nancy"
WORDS = frozenset((_GENERAL + _SOFTWARE + _NAMES).split())



def split_words(text: str) -> list[str]:
    """Parts at underscores and before upper-case letters, in lower case."""
    parts, start = [], 0
    for i, c in enumerate(text):
        if c == "_" or c.isupper():
            parts.append(text[start:i])
            start = i + (c == "_")
    parts.append(text[start:])
    return [p.lower() for p in parts if p]


def is_word(text: str, words: Collection[str] = WORDS) -> bool:
    """In the vocabulary, or of mixed case with every part in it."""
    low = text.lower()
    if low in words:
        return True
    if text in (low, text.upper()):
        return False
    parts = split_words(text)
    return bool(parts) and all(p in words for p in parts)
